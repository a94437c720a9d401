"""Connected components of a graph given as edges: by alternating large and small stars, or in one task where they are few."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, prepare, skew_join

#: Far beyond the logarithmic number of rounds that any graph needs.
MOST_ROUNDS = 64
#: Edges, of 16 bytes, that one task holds at once.
FEW = 1 << 18


def _large(e: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to the least of its neighbourhood; ``e`` is (a, b) with a > b."""
    # a node's least neighbour: of its smaller ones if it has any, else it is the least itself
    least = e.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
    up = skew_join(e, e.select("b").distinct().join(least, "b", "left"), "b", "a")  # larger neighbours a of b
    return up.select("a", F.coalesce("m", "b").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, go to the least of them."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    inner = skew_join(e, least, "a", "b").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.unionByName(least.select("a", F.col("m").alias("b")))


def labelled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node but the least of its component, and that least node: roots are hooked to smaller roots, and paths halved."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    out = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[out], nodes[root[out]]


def _alone(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = [(f["a"].to_numpy(np.int64), f["b"].to_numpy(np.int64)) for f in frames]
    if held:
        a, b = labelled(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pd.DataFrame({"a": a, "b": b})


def components(edges: DataFrame, written: bool = False) -> DataFrame:
    """(a, b): every node with an edge to another but the least of its component, and that least node.

    Up to FEW edges, by their count, go to one task.  More are halved in rounds: minima are aggregated before each
    shuffle, and the joins that hand them back spread the links of a node with many, so a hub's star is no one
    task's list.  Each round is written, so lost executors cost one round.  Both ways give the same rows.
    Few edges that are a written table already are not written once more.
    """
    prepare(edges.sparkSession)
    if written and edges.count() <= FEW:
        told = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return materialize(told.coalesce(1).mapInPandas(_alone, "a long, b long"), "edges")
    e = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if e.count() <= FEW:
        done = materialize(e.coalesce(1).mapInPandas(_alone, "a long, b long"), "edges")
        discard(e)
        return done
    seen = None
    for _ in range(MOST_ROUNDS):
        wide = materialize(_large(e).distinct(), "edges")
        new = materialize(_small(wide).distinct(), "edges")
        discard(wide)
        discard(e)
        e = new
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            return e
        seen = now
    raise RuntimeError("components did not settle")
