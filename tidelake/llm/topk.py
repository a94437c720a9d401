"""Exact top-k inner products: an impact-ordered index, evaluated score at a time.

Vectors are quantised to whole numbers.  Candidates are dealt into blocks; in a
block, the postings of all dimensions are cut into segments by the size of their
impact, the largest first.  A segment of few postings holds lists (of each
dimension: candidates and impacts); one that holds most of the block's entries is
a plane, since the postings of dense vectors are a matrix.  Segments are processed
in order for a block of queries at once, adding to accumulators.  After each
segment, what the rest can still add to or take from a score is bounded by the
largest impact left times the query's absolute sum.  A candidate stays possible
while its upper bound reaches the k-th best lower bound, in its block or in the
blocks before; processing stops only when the proof has left so few candidates
that scoring them exactly is cheaper than another segment.  Those are rescored
exactly from the whole vectors, so quantised impacts and bounds decide only what
need not be scored.

Queries go out in chunks of bounded size, and each chunk meets every block; what
a query's best are is carried from block to block, and a task tells k a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, prepare, table

K = 5
#: Segments of a block's postings, by falling impact: shares of the block's largest impact.
LEVELS = (0.5, 0.35, 0.25, 0.17, 0.11, 0.07, 0.04, 0.0)
#: Candidates of a block, bytes of it, and queries that meet it at once: bound a task's memory.
BLOCK, BLOCK_BYTES, STEP = 8192, 8 << 20, 512
#: Segments that hold a smaller share of a block's entries are lists, the others planes.
LISTED = 1 / 32
#: Bytes of queries that are broadcast at once.
CHUNK_BYTES = 16 << 20


def quantise(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component as double; null if the vector or a component is null or not finite."""

    def bad(x: Column) -> Column:
        d = x.cast("double")
        return x.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))

    return F.when(vector.isNotNull() & ~F.exists(vector, bad), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


class Block:
    """One block's postings in segments by falling impact: (lists by dimension, or a plane; largest impact left)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, levels: tuple[float, ...] = LEVELS):
        self.ids, self.x = ids, x
        size = np.abs(x)
        top = size.max(initial=0)
        lows = [int(top * lv) for lv in levels[:-1]] + [1]
        self.segments: list[tuple[list[tuple[int, np.ndarray, np.ndarray]] | np.ndarray, int]] = []
        high = top + 1
        for low in lows:
            if low >= high:
                continue
            held = (size >= low) & (size < high)
            if held.sum() < LISTED * x.size:
                lists = [(int(d), c := np.flatnonzero(held[:, d]), x[c, d].astype(np.float64)) for d in np.flatnonzero(held.any(axis=0))]
                self.segments.append((lists, max(0, low - 1)))
            else:
                self.segments.append((np.where(held, x, 0).astype(np.float64), max(0, low - 1)))
            high = low

    def search(self, qids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
        """(query position, vec_id, score) of each query's k best, ties to smaller ids, and what was done.

        Candidates below a query's ``floor`` need not come out."""
        n, stats = len(self.ids), {"segments": 0, "rescored": 0}
        qf = q.astype(np.float64)
        reach = np.abs(qf).sum(axis=1)
        acc = np.zeros((len(q), n))
        own = self.ids[None, :] == qids[:, None]
        lowest = np.full(len(q), -np.inf) if floor is None else floor
        open_, done = np.arange(len(q)), []
        for segment, rest in self.segments or [([], 0)]:
            if isinstance(segment, list):
                part = np.zeros((n, len(open_)))
                for d, at, impact in segment:
                    part[at] += impact[:, None] * qf[open_, d]
                acc[open_] += part.T
            else:
                acc[open_] += qf[open_] @ segment.T
            stats["segments"] += len(open_)
            a = np.where(own[open_], -np.inf, acc[open_])
            slack = reach[open_, None] * rest
            least = lowest[open_, None]
            if n > k:
                least = np.maximum(least, np.partition(a, n - k, axis=1)[:, n - k : n - k + 1] - slack)
            possible = (a + slack >= least) & ~own[open_]
            few = (possible.sum(axis=1) <= max(4 * k, n // 64)) | (rest == 0)
            for i in np.flatnonzero(few):
                done.append((open_[i], np.flatnonzero(possible[i])))
            open_ = open_[~few]
            if not len(open_):
                break
        out_q, out_id, out_s = [], [], []
        for i, members in done:
            if not len(members):
                continue
            s = self.x[members] @ q[i]  # whole numbers, exact
            stats["rescored"] += len(members)
            best = np.lexsort((self.ids[members], -s))[:k]
            out_q.append(np.full(len(best), i))
            out_id.append(self.ids[members[best]])
            out_s.append(s[best])
        if not out_q:
            none = np.zeros(0, np.int64)
            return none, none, none, stats
        return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_s), stats


class Best:
    """The k best so far of each of n queries."""

    def __init__(self, n: int, k: int):
        self.k, self.q, self.id, self.s = k, *[np.zeros(0, np.int64)] * 3
        self.floor = np.full(n, -np.inf)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(q):
            return
        q, ids, scores = np.append(self.q, q), np.append(self.id, ids), np.append(self.s, scores)
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < self.k
        self.q, self.id, self.s = q[keep], ids[keep], scores[keep]
        last = np.arange(len(q)) - first == self.k - 1
        self.floor[q[last]] = scores[last]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates but itself, all if fewer.

    Candidates and queries need not overlap.  Null ids and vectors quantise() leaves null take no part; rows
    that repeat an id are candidates each for itself, and a query's repeats give its rows once (the vector that is
    least, if they differ).  A vector shorter than another counts as if zeros followed, an empty one as all zeros.
    Ties go to smaller ids.  An empty table gives no rows; other columns, whatever their names, are not read.
    Components too large for exact sums in doubles (products beyond 2**53) are an error.
    """
    spark = vectors.sparkSession
    prepare(spark)
    pick = lambda df: df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), quantise(F.col(f"`{embedding}`"), scale).alias("v")).where("id is not null and v is not null")
    whole = pick(vectors)
    asked = materialize(pick(queries).groupBy("id").agg(F.min("v").alias("v")), "queries")
    n, width = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, width)
    chunks = max(1, -(-n * width * 8 // CHUNK_BYTES))
    size = max(64, min(BLOCK, BLOCK_BYTES // (8 * width)))

    def matrix(v: pd.Series) -> np.ndarray:
        """Rows of the queries' width: what is missing is zero, and what goes beyond it meets zeros."""
        n = np.fromiter((min(len(x), width) for x in v), np.int64, len(v))
        if (n == width).all():
            return np.stack([x[:width] for x in v]).astype(np.int64) if len(v) else np.zeros((0, width), np.int64)
        out = np.zeros((len(v), width), np.int64)
        for i, x in enumerate(v):
            out[i, : n[i]] = x[:width]
        return out

    def run(frames: Iterator[pd.DataFrame], shared) -> Iterator[pd.DataFrame]:
        qids, q = shared.value
        largest = float(np.abs(q).max(initial=1))
        ids, vecs, have = [], [], 0
        best = [Best(len(qids[s : s + STEP]), k) for s in range(0, len(qids), STEP)]

        def close() -> None:
            nonlocal have
            if have:
                block = Block(np.concatenate(ids), np.concatenate(vecs))
                ids.clear()
                vecs.clear()
                have = 0
                for b, s in zip(best, range(0, len(qids), STEP), strict=True):
                    b.add(*block.search(qids[s : s + STEP], q[s : s + STEP], k, b.floor)[:3])

        for b in frames:
            for s in range(0, len(b), size):
                part = b.iloc[s : s + size]
                v = matrix(part["v"])
                if v.size and float(np.abs(v).max()) * largest * width >= 2.0**53:
                    raise ValueError("components are too large for exact scores")
                ids.append(part["id"].to_numpy(np.int64))
                vecs.append(v)
                have += len(part)
                if have >= size:
                    close()
        close()
        for b, s in zip(best, range(0, len(qids), STEP), strict=True):
            yield pd.DataFrame({"query_id": qids[s + b.q], "vec_id": b.id, "score": b.s})

    found = None
    for c in range(chunks):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == c).toPandas().sort_values("id")  # CHUNK_BYTES, about
        if part.empty:
            continue
        shared = spark.sparkContext.broadcast((part["id"].to_numpy(np.int64), matrix(part["v"])))
        got = materialize(whole.mapInPandas(lambda f, s=shared: run(f, s), "query_id long, vec_id long, score long"), "topk")
        shared.unpersist()
        found = got if found is None else found.unionByName(got)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.pmod("vec_id", F.lit(50)) == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
