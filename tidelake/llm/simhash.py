"""SimHash near-duplicates: fingerprints, BK-trees within shards, components.

Two fingerprints within radius r agree in at least three of r + 3 blocks of
bits.  So each distinct fingerprint goes to one shard for each choice of three
blocks, keyed by their bits; no close pair escapes and no shard holds a large
part of the corpus.  In a shard the fingerprints form a BK-tree (children keyed
by integer Hamming distance to their parent), and the search follows only edges
within the radius.  A shard that is too large hands its fingerprints on to finer
shards by the bits that are still free.  Shards give spanning links, not pairs.

The trees are built where their shard's rows meet; they aren't broadcast, since
all trees together grow with the corpus.

Near-duplicates at a similarity threshold (``near_groups``, ``dedup`` of ``near``)
need more than 64 bits: there the BK-trees hold the sets of shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, prepare, skew_join, table
from .components import components
from .near import dedup, near_groups

SEED = 42
RADIUS = 3
SHINGLE = 3
#: Fingerprints that one tree holds; larger shards are split by more bits.
TREE = 2048
_STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, signed; 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[n - 1 :].tolist()
    first = starts[: len(last)].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(last), _STEP):
        h = np.array([digest(flat[a:b], SEED) for a, b in zip(first[at : at + _STEP], last[at : at + _STEP], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(last), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a long."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([fingerprint(t, shingle) for t in part], dtype="int64")

    return docs.withColumn(name, F.pandas_udf(run, "long")(F.col(text)))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of 64-bit fingerprints, or of rows of several words."""
    d = np.bitwise_count(a ^ b)
    return (d.sum(axis=1) if d.ndim > 1 else d).astype(np.int16)


def tree_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (i, j) of the groups that links of at most ``radius`` bits make among distinct fingerprints.

    The BK-tree is walked for all fingerprints at once: a node is met by those whose
    distance to its parent lies within the radius of the node's edge.
    """
    label = np.arange(len(fps))
    todo = [(np.arange(len(fps)), np.arange(len(fps)))]  # (subtree in order of insertion, who comes here)
    while todo:
        members, askers = todo.pop()
        root = members[0]
        d = distance(fps[askers], fps[root])
        near = np.unique(label[askers[d <= radius]])
        near = np.union1d(near, label[[root]])
        if len(near) > 1:
            label[np.isin(label, near)] = near[0]
        if len(members) == 1:
            continue
        below = members[1:]
        edge = distance(fps[below], fps[root])
        for e in np.unique(edge):
            come = askers[np.abs(d - e) <= radius]
            if len(come) > 1:  # a child is always its own asker
                todo.append((below[edge == e], come))
    i = np.flatnonzero(label != np.arange(len(fps)))
    return i, label[i]


def blocks(free: list[int], radius: int) -> list[list[int]]:
    """The free bit positions in radius + 3 blocks, as even as can be, or a block a bit."""
    n = min(radius + 3, len(free))
    return [b.tolist() for b in np.array_split(np.asarray(free), n)]


def masks(free: list[int], radius: int) -> list[int]:
    """Bits of each choice of the blocks that must stay equal."""
    parts = blocks(free, radius)
    keep = len(parts) - radius
    return [sum(1 << b for p in c for b in p) for c in combinations(parts, keep)] if keep > 0 else []


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """(a, b): links that span each group of the distinct fingerprints in ``fps.fp``."""
    spark = fps.sparkSession
    prepare(spark)

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []  # the open shard's fingerprints, as far as they are kept
        key, fixed, spill = None, 0, False
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray] = []
        over: list[tuple[int, np.ndarray]] = []

        def close() -> None:
            nonlocal held
            if not spill and held:
                x = np.unique(np.concatenate(held))
                if len(x) > 1:
                    i, j = tree_links(x.view(np.uint64), radius)
                    out_a.append(x[i])
                    out_b.append(x[j])
            held = []

        def finer() -> Iterator[pd.DataFrame]:
            for f, x in over:
                free = [b for b in range(64) if not f >> b & 1]
                for m in masks(free, radius):
                    k = f | m
                    yield pd.DataFrame({"a": x & np.int64(_signed(k)), "b": x, "fixed": np.int64(_signed(k))})
            over.clear()

        for batch in batches:
            k = batch["key"].to_numpy(np.int64)
            m = batch["fixed"].to_numpy(np.int64)
            x = batch["fp"].to_numpy(np.int64)
            cut = np.flatnonzero((k[1:] != k[:-1]) | (m[1:] != m[:-1])) + 1
            bounds = [0, *cut.tolist(), len(k)]
            for s, e in zip(bounds, bounds[1:], strict=False):
                if s == e:
                    continue
                if (k[s], m[s]) != key:
                    close()
                    key, fixed, spill = (k[s], m[s]), int(m[s]) & (2**64 - 1), False
                held.append(x[s:e])
                free = 64 - fixed.bit_count()
                if (spill or sum(map(len, held)) > tree) and 1 << free > tree:
                    spill = True
                    over.extend((fixed, h) for h in held)
                    held = []
            if over:
                yield from finer()
            if out_a:
                yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b), "fixed": np.int64(0)})
                out_a.clear()
                out_b.clear()
        close()
        if out_a:
            yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b), "fixed": np.int64(0)})

    level = fps.select("fp").distinct()
    choices = F.array(*[F.lit(_signed(m)) for m in masks(list(range(64)), radius)])
    rows = level.select("fp", F.explode(choices).alias("fixed")).select(F.col("fp").bitwiseAND(F.col("fixed")).alias("key"), "fixed", "fp")
    found: list[DataFrame] = []
    while True:
        dealt = rows.repartition("key", "fixed").sortWithinPartitions("fixed", "key")
        out = materialize(dealt.select("key", "fixed", "fp").mapInPandas(shard, "a long, b long, fixed long"), "links")
        found.append(out.where("fixed = 0").select("a", "b"))
        finer = out.where("fixed <> 0")
        if finer.isEmpty():
            return reduce(DataFrame.unionByName, found)
        rows = finer.select(F.col("a").alias("key"), "fixed", F.col("b").alias("fp"))


def group(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id for each row of ``docs``.

    Copies share a fingerprint and meet there, however many they are.  Null, empty and
    blank texts have fingerprint 0, which links like any other; rows with a null doc_id
    link too, and name a component only if it has no other id (then null).
    """
    marked = materialize(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")), "text", shingle).select("doc_id", "fp"), "fp")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = links(least.select("fp"), radius)
    roots = components(found, written=True)
    placed = least.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "placed")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = skew_join(placed, named, "root", "fp").select("fp", "component_id")
    return skew_join(marked, by_fp, "fp", "doc_id").select("doc_id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = group(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


__all__ = ["dedup", "fingerprint", "fingerprints", "group", "links", "near_groups", "tree_links", "op6_simhash"]
