"""Near-duplicates at a Jaccard similarity: SimHash and MinHash bands name candidates, BK-trees over shingle sets decide.

Each distinct set of shingles has the component of its text's SimHash as a key (``simhash``: BK-trees within shards,
links of at most three bits), and, since 64 bits tell most pairs at the threshold no more from others, ``BANDS``
keys of ``ROWS`` MinHash values for the rest.  Sets that share a key are candidates; the components of this candidate graph are small, and a component's sets meet in one shard, where a
BK-tree on the integer Hamming distance of the sets (shingles that only one of two holds) finds all pairs whose
similarity is high enough, on the sets themselves.  So no pair below the threshold is linked, no pair is written
out, and a pair at the threshold is missed only if its texts share no key and are in no component together:
(1 - 0.8**5)**24, below 0.0001.

A component too large for a shard is cut into blocks, and each two blocks make a shard; one far too large is
first taken apart by its keys.  Copies a document therefore do not depend on how many documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import attach, discard, hot_parts, materialize, prepare, salted, skew_join
from .components import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: Sets and shingles that one shard holds at most, about; and blocks that a component is cut into before its keys take it apart.
MEMBERS, SHARD, BLOCKS = 2048, 1 << 20, 16

_FACTORS = np.random.default_rng(7).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def sets_of(texts: list[str | None], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of all texts, sorted within a text, and how many each text has.

    A text of fewer words than a shingle is one shingle, one without words has none; A-Z count as a-z.
    """
    parts, sizes = [], np.zeros(len(texts), np.int64)
    for first, raws in hashing.steps((t or "").encode("utf-8", "replace").lower() for t in texts):
        raw, begin = hashing.join(raws)
        start, end = hashing.runs(~_SPACE[raw])
        if not len(start):
            continue
        codes = hashing.Ranges(raw)(start, end)
        doc = np.searchsorted(begin, start, side="right") - 1
        left = np.append(np.flatnonzero(np.diff(doc)) + 1, len(doc))
        left = np.repeat(left, np.diff(np.concatenate([[0], left]))) - np.arange(len(doc))  # words from here to the text's end
        own = np.concatenate([[True], np.diff(doc) != 0])
        at = np.flatnonzero((left >= shingle) | own)
        h = hashing.Ranges(hashing.mixed(codes))(at, at + np.minimum(left[at], shingle))
        d = doc[at]
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        keep = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
        parts.append(h[keep])
        sizes[first : first + len(raws)] = np.bincount(d[keep], minlength=len(raws))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes


def marks_of(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the texts that have shingles: a key of the set, and its band keys."""
    n = sizes[sizes > 0]
    if not len(n):
        return np.zeros(0, np.int64), np.zeros((0, BANDS), np.int64)
    begin = np.cumsum(n) - n
    key = hashing.mixed(np.add.reduceat(hashing.mixed(h), begin) ^ hashing.mixed(n.astype(np.uint64)))
    bands = np.empty((len(n), BANDS), np.uint64)
    for b in range(BANDS):
        x = np.full(len(n), b + 1, np.uint64)
        for f in _FACTORS[b * ROWS : (b + 1) * ROWS]:
            x = hashing.mixed(x + hashing.mixed(np.minimum.reduceat(h * f, begin)))
        bands[:, b] = x
    return key.view(np.int64), bands.view(np.int64)


class Sets:
    """Sets of shingles and how many any of them have in common: shingles of many sets as bits, the others as lists."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        m = len(sets)
        flat = np.concatenate(sets)
        of = np.repeat(np.arange(m), self.n)
        order = np.argsort(flat, kind="stable")
        of = of[order]
        head = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
        count = np.diff(np.append(head, len(of)))
        wide = count * 64 >= max(m, 128)
        dim = np.repeat(np.where(wide, np.cumsum(wide) - 1, -1), count)
        at = np.flatnonzero(dim >= 0)
        bits = np.zeros((m, -(-int(wide.sum()) // 64) * 64 or 64), bool)
        bits[of[at], dim[at]] = True
        self.bits = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        listed = (count > 1) & ~wide
        self.list = of[np.repeat(listed, count)]  # holders of each listed shingle
        size = count[listed]
        begin = np.cumsum(size) - size
        entry = np.repeat(np.arange(len(size)), size)
        by = np.argsort(self.list, kind="stable")
        self.own = entry[by]  # listed shingles of each set
        self.own0 = np.searchsorted(self.list[by], np.arange(m + 1))
        self.begin, self.size = begin, size

    def common(self, root: int, others: np.ndarray) -> np.ndarray:
        """How many shingles the root shares with each of the others."""
        out = np.bitwise_count(self.bits[others] & self.bits[root]).sum(axis=1, dtype=np.int64)
        mine = self.own[self.own0[root] : self.own0[root + 1]]
        if len(mine):
            n = self.size[mine]
            place = np.repeat(self.begin[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out += np.bincount(self.list[place], minlength=len(self.n))[others]
        return out


def tree_links(sets: list[np.ndarray], ratio: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (i, j) of the groups that pairs of at least the similarity make.

    A BK-tree keyed by the Hamming distance of the sets, searched for all sets at once: a node is met by the sets
    after it whose distance to its parent lies within their radius of the node's edge.  The radius of a set is the
    largest distance to any set as similar as asked.  Sets that a subtree is linked with already don't enter it.
    """
    p, q = ratio.numerator, ratio.denominator
    m = len(sets)
    label = np.arange(m)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True)) * (p + q) >= (len(sets[0]) + len(sets[1])) * p
        return (np.array([1]), np.array([0])) if both else (label[:0], label[:0])
    held = Sets(sets)
    n = held.n
    radius = n * (q - p) // p
    inside = np.zeros(m, bool)
    todo = [(np.arange(m), np.arange(1, m))]  # (subtree in order of insertion, later sets that come here)
    while todo:
        members, askers = todo.pop()
        root = members[0]
        if not len(askers):
            continue
        common = held.common(root, askers)
        sums = n[askers] + n[root]
        near = np.unique(label[askers[common * (p + q) >= sums * p]])
        if len(near):
            near = np.union1d(near, label[[root]])
            label[np.isin(label, near)] = near[0]
        if len(members) == 1:
            continue
        d = sums - 2 * common
        below = members[1:]
        edge = d[np.searchsorted(askers, below)]
        by = np.argsort(edge, kind="stable")
        cut = np.flatnonzero(np.diff(edge[by])) + 1
        for child in np.split(by, cut):
            e, child = edge[child[0]], below[child]
            come = np.abs(d - e) <= radius[askers]
            come &= askers > child[0]
            others = askers[come]
            first = label[child[0]]
            if (label[child] == first).all():
                inside[child] = True
                others = others[inside[others] | (label[others] != first)]
                inside[child] = False
            if len(others):
                todo.append((child, others))
    i = np.flatnonzero(label != np.arange(m))
    return i, label[i]


def _search(frames: Iterator[pd.DataFrame], ratio: Fraction) -> Iterator[pd.DataFrame]:
    """Links (a, b) of each shard; rows (shard, u, h) come sorted by shard."""
    key, us, sets = None, [], []
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []

    def close() -> None:
        if len(us) > 1:
            u, first = np.unique(np.array(us, np.int64), return_index=True)
            if len(u) > 1:
                i, j = tree_links([np.frombuffer(sets[k], np.uint64) for k in first], ratio)
                out_a.append(u[i])
                out_b.append(u[j])
        us.clear()
        sets.clear()

    for b in frames:
        for shard, u, h in zip(b["shard"], b["u"], b["h"], strict=True):
            if shard != key:
                close()
                key = shard
            us.append(u)
            sets.append(h)
        if out_a:
            yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})
            out_a.clear()
            out_b.clear()
    close()
    if out_a:
        yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def with_simhash(reps: DataFrame) -> DataFrame:
    """``reps`` whose ``bands`` hold one key more: the component of fingerprints that ``fp`` is in."""
    from .simhash import links

    roots = components(links(reps.select("fp")), written=True).select(F.col("a").alias("fp"), F.col("b").alias("_root"))
    keyed = reps.join(roots, "fp", "left").withColumn("bands", F.array_append("bands", F.xxhash64(F.coalesce("_root", "fp"), F.lit(BANDS))))
    return materialize(keyed.drop("fp", "_root"), "reps")


def candidates(reps: DataFrame) -> DataFrame:
    """(u, root): sets that share a band key with another, by component of the graph of shared keys."""
    keyed = materialize(reps.select("u", F.explode("bands").alias("key")), "keyed")
    parts = hot_parts(keyed, "key")
    by = salted(keyed, "key", "u", parts)
    least = "min(u) over (partition by key, _salt)"
    edges = by.select("u", F.expr(least).alias("p")).where("u <> p")
    if parts:  # the salts of a hot key are joined by their least members
        tops = by.where("_hot").groupBy("key", "_salt").agg(F.min("u").alias("u"))
        edges = edges.unionByName(tops.select("u", F.expr("min(u) over (partition by key)").alias("p")).where("u <> p"))
    roots = components(edges.select(F.col("u").alias("a"), F.col("p").alias("b")))
    discard(keyed)
    return roots.select(F.col("a").alias("u"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("u"), F.col("b").alias("root")).distinct())


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """(u, shard) for rows (u, key, members, weight): one shard a key, or one for each two of its blocks."""
    each = F.greatest(F.ceil(2 * F.col("members") / MEMBERS), F.ceil(2 * F.col("weight") / SHARD)).cast("int")
    whole = (F.col("members") <= MEMBERS) & (F.col("weight") <= SHARD)
    cut = rows.withColumn("_n", F.when(whole, F.lit(1)).otherwise(F.greatest(each, F.lit(2))))
    cut = cut.withColumn("_b", F.pmod(F.xxhash64("u", F.lit(1)), F.col("_n")).cast("int"))
    one = F.array(F.xxhash64(F.col(key), F.lit(0), F.lit(0)))
    many = F.transform(F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda j: j != F.col("_b")), lambda j: F.xxhash64(F.col(key), F.least(j, F.col("_b")), F.greatest(j, F.col("_b"))))
    return cut.select("u", F.explode(F.when(F.col("_n") == 1, one).otherwise(many)).alias("shard"))


def shards(reps: DataFrame, found: DataFrame) -> DataFrame:
    """(u, shard): the shards that each candidate's set goes to."""
    cand = materialize(found.join(reps.select("u", "n"), "u"), "candidates")
    sizes = cand.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    rows = skew_join(cand, sizes, "root", "u")
    giant = (2 * F.col("members") > BLOCKS * MEMBERS) | (2 * F.col("weight") > BLOCKS * SHARD)
    out = _blocks(rows.where(~giant), "root")
    huge = sizes.where(giant).select("root")
    if not huge.isEmpty():
        keyed = materialize(skew_join(cand, huge, "root", "u").join(reps.select("u", "bands"), "u").select("u", "n", F.explode("bands").alias("key")), "giants")
        keys = keyed.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("weight")).where("members > 1")
        out = out.unionByName(_blocks(skew_join(keyed, keys, "key", "u"), "key"))
    return out


def near_groups(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """All columns of ``docs`` and component_id: the least doc_id of the near-duplicates of the row's text.

    Two texts are linked if the Jaccard similarity of their sets of shingles (64-bit hashes) is at least
    ``similarity``; links make components.  Whole texts count, however long.  Equal sets (copies among them) are
    one entry before the search, however many they are.  Texts without words are no one's duplicate and keep
    their own doc_id; rows with a null doc_id stand alone too (null).  Rows that repeat a doc_id share the least
    component of their texts.  An empty table gives no rows.  A column component_id of ``docs`` is replaced;
    any other name may occur in ``docs``.
    """
    spark = docs.sparkSession
    from . import simhash

    prepare(spark)
    ratio = Fraction(str(similarity))
    doc = F.col("doc_id").cast("long")

    def marks(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            u, size, bands = pd.array([None] * len(part), "Int64"), np.zeros(len(part), np.int64), np.empty(len(part), object)
            fp = np.fromiter((simhash.fingerprint(t) for t in part), np.int64, len(part))
            for s in range(0, len(part), 256):
                h, n = sets_of(list(part[s : s + 256]), shingle)
                key, b = marks_of(h, n)
                size[s : s + 256] = n
                at = s + np.flatnonzero(n)
                u[at] = key
                for i, k in enumerate(at.tolist()):
                    bands[k] = b[i]
            yield pd.DataFrame({"u": u, "n": size, "bands": bands, "fp": fp})

    # called once a row: not once more for the filter, in a second worker
    marked = F.pandas_udf(marks, "u long, n long, bands array<long>, fp long").asNondeterministic()
    slim = docs.select(doc.alias("doc_id"), marked(F.col(text)).alias("m"))
    slim = materialize(slim.where("doc_id is not null and m.u is not null").select("doc_id", "m.*"), "marks")
    reps = materialize(slim.groupBy("u").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("fp").alias("fp")), "reps")
    reps = with_simhash(reps)
    found = candidates(reps)
    # at most (BANDS + 1) * BLOCKS shards a set
    asked = shards(reps, found).distinct().groupBy("u").agg(F.collect_list("shard").alias("_shards")).join(reps.select("u", "least"), "u")
    asked = asked.select(F.col("u").alias("_u"), F.col("least").alias("_id"), "_shards")

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in frames:
            for s in range(0, len(b), 256):
                part = b.iloc[s : s + 256]
                h, n = sets_of(list(part["text"]), shingle)
                end = np.cumsum(n)
                key = np.zeros(len(n), np.int64)
                key[n > 0] = marks_of(h, n)[0] if len(h) else 0
                rows = [(k, u, h[e - c : e].tobytes()) for u, ks, c, e, own in zip(part["_u"], part["_shards"], n.tolist(), end.tolist(), key.tolist(), strict=True) if own == u and c for k in ks]
                if rows:
                    yield pd.DataFrame(rows, columns=["shard", "u", "h"])

    texts = docs.select(doc.alias("_id"), F.col(text).cast("string").alias("text")).join(asked, "_id").select("text", "_u", "_shards")
    dealt = texts.mapInPandas(deal, "shard long, u long, h binary").repartition("shard").sortWithinPartitions("shard")
    links = materialize(dealt.mapInPandas(lambda f: _search(f, ratio), "a long, b long"), "near")
    roots = components(links)
    placed = reps.select("u", "least").join(roots.select(F.col("a").alias("u"), F.col("b").alias("root")), "u", "left").select("u", "least", F.coalesce("root", "u").alias("root"))
    placed = materialize(placed, "placed")
    named = placed.groupBy("root").agg(F.min("least").alias("_component"))
    named = materialize(skew_join(placed, named, "root", "u").select("u", "least", "_component"), "named")
    # who stays is decided on ids alone, so the texts are not shuffled with hot sets
    ids = skew_join(slim.select("doc_id", "u"), named.select("u", "_component"), "u", "doc_id").groupBy("doc_id").agg(F.min("_component").alias("component_id"))
    out = attach(docs, {"doc_id": doc}, ids)
    return out.withColumn("component_id", F.coalesce("component_id", doc))


def dedup(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the least doc_id.

    Rows that repeat the least doc_id all stay but if they are equal in every column.  Rows without words and
    rows with a null doc_id stay.  Columns are passed through whatever their names, component_id too.
    """
    columns = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(columns)], F.col("doc_id"), F.col(f"`{text}`").alias("_text"))
    plain = plain.withColumn("_row_hash", F.xxhash64(*[F.col(f"_k{i}").cast("string") for i in range(len(columns))]))
    named = near_groups(plain, "_text", shingle, similarity)
    own = F.col("doc_id").cast("long")
    # the rows of an id already lie together after the join, so repeats go without another shuffle
    again = F.expr("row_number() over (partition by cast(doc_id as long), _row_hash order by 1)")
    kept = named.where(F.col("doc_id").isNull() | (F.col("component_id") == own)).withColumn("_again", again)
    return kept.where(F.col("doc_id").isNull() | (F.col("_again") == 1)).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(columns)])
