"""Substring dedup: compressed FM-indexes per shard find word sequences that recur.

Every window of 13 words goes to the shard of its least three-word hash (its
minimiser).  Windows that follow one another mostly share it and travel as one
segment, so equal windows meet in one shard wherever they stand, and a shard
holds an even part of the corpus.  In a shard the segments' words form a text,
over whose Burrows-Wheeler transform a wavelet matrix answers ranks from packed
bits; backward search of the shard's own windows, all at once, gives their
matching statistics, and the documents of a suffix range give the first
document that has a window.

Segments travel as the words themselves, compressed, so words are compared by
64 hash bits without 64 bits a word being sent.  Copies of a segment within a
step are collapsed before the shuffle, word by word: only the smallest doc_id's
is sent, the others are known to be repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashing
from .common import attach, materialize, prepare, table

WINDOW = 13
_GRAM = 3
#: Windows of a segment at most (a run of one minimiser is longer only in text that repeats one word).
_LONGEST = 32
#: Bytes of text for each shard, about: bounds what a task holds at once.
SHARD_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_SEG = np.dtype([("doc", "<i8"), ("row", "<u4"), ("at", "<u4"), ("n", "u1")])
_CUT = np.dtype([("doc", "<i8"), ("row", "<u4"), ("at", "<u4"), ("end", "<u4")])


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of each three codes that follow one another."""
    c = codes.astype(np.uint64)
    return hashing.mixed((c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ hashing.mixed(c[1:-1] + hashing.mixed(c[2:])))


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values that follow one another."""
    m, have = g, 1
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[:-step], m[step:])
        have += step
    return m


class WaveletMatrix:
    """Ranks over a sequence of small integers, from bits packed into words with a count for each word."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        order = seq.astype(np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bit = (order >> np.uint32(level)) & np.uint32(1) != 0
            packed = np.packbits(np.concatenate([bit, np.zeros(128 - len(bit) % 64, bool)]), bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(len(bit) - int(bit.sum()))
            order = np.concatenate([order[~bit], order[bit]])
        self.first = np.searchsorted(_reversed_key(order, self.levels), _reversed_key(np.arange(sigma, dtype=np.uint32), self.levels))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        i = upto
        for k in range(self.levels):
            w = i >> 6
            ones = self.counts[k][w] + np.bitwise_count(self.words[k][w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))).astype(np.int64)
            i = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, i - ones)
        return i - self.first[symbol]


def _reversed_key(x: np.ndarray, levels: int) -> np.ndarray:
    """Bits in reverse: the order in which a wavelet matrix leaves its symbols."""
    out = np.zeros(len(x), np.int64)
    for k in range(levels):
        out |= ((x >> np.uint32(k)) & np.uint32(1)).astype(np.int64) << (levels - 1 - k)
    return out


class FMIndex:
    """Backward search over a text of symbols 1.. with 0 between its parts, for patterns of at most 16 symbols.

    ``owner`` numbers the text's places by whose they are, in an order of which the least counts."""

    def __init__(self, text: np.ndarray, sigma: int, owner: np.ndarray):
        rank, span = text.astype(np.int64), 1
        top = sigma
        while span < 16:
            after = np.zeros_like(rank)
            after[:-span] = rank[span:] + 1
            _, rank = np.unique(rank * (top + 2) + after, return_inverse=True)
            rank = rank.astype(np.int64)
            top, span = int(rank.max()) + 1, span * 2
        order = np.argsort(rank, kind="stable").astype(np.int32)  # suffixes by their first 16 symbols
        self.heads = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        # of the suffixes only their owners' numbers are kept, in as few bytes as they need
        self.owner = owner[order].astype(np.min_scalar_type(int(owner.max(initial=0))))

    def statistics(self, text: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the patterns text[at:at+length]: suffix range (lo, hi) and how many symbols, read
        backward, match at some other place too; the search of a pattern ends when none does."""
        c = text[at + length - 1].astype(np.int64)
        lo, hi = self.heads[c].copy(), self.heads[c + 1].copy()
        matched = np.where(hi - lo > 1, 1, 0)
        live = np.flatnonzero(hi - lo > 1)
        for j in range(length - 2, -1, -1):
            if not len(live):
                break
            c = text[at[live] + j].astype(np.int64)
            both = self.bwt.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            a, b = self.heads[c] + both[: len(c)], self.heads[c] + both[len(c) :]
            more = b - a > 1
            lo[live], hi[live] = a, b
            live = live[more]
            matched[live] += 1
        return lo, hi, matched


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer, and their codes."""
    start, end = hashing.runs(~_SPACE[raw])
    return start, end, hashing.Ranges(raw)(start, end)


def _segments(raws: list[bytes], docs: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of the texts, their minimisers, the codes of all words, which word of these each segment begins with,
    and from where to where its words stand in the buffer of the texts."""
    raw, begin = hashing.join(raws)
    start, end, codes = _words(raw)
    none = np.zeros(0, _SEG), np.zeros(0, np.uint64), codes, *[np.zeros(0, np.int64)] * 3
    if len(start) < window:
        return none
    doc = np.searchsorted(begin, start, side="right") - 1
    least = _least(_grams(codes), window - _GRAM + 1)
    whole = np.flatnonzero(doc[window - 1 :] == doc[: len(doc) - window + 1])  # windows within one text
    if not len(whole):
        return none
    m, d = least[whole], doc[whole]
    new = np.concatenate([[True], (m[1:] != m[:-1]) | (d[1:] != d[:-1]) | (whole[1:] != whole[:-1] + 1)])
    run = np.flatnonzero(new)
    within = np.arange(len(whole)) - np.repeat(run, np.diff(np.append(run, len(whole))))
    first = np.flatnonzero(within % _LONGEST == 0)
    seg = np.zeros(len(first), _SEG)
    of = d[first]
    word0 = np.searchsorted(doc, np.arange(len(raws)))
    seg["doc"], seg["row"], seg["at"] = docs[of], rows[of], whole[first] - word0[of]
    seg["n"] = np.diff(np.append(first, len(whole)))
    at = whole[first]
    return seg, m[first], codes, at, start[at], end[at + seg["n"] + window - 2]


def _copies(key: np.ndarray, doc: np.ndarray, codes: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments by key, then doc, and for each of them where its group of equal segments begins in that order.

    Segments of one key are compared code by code; should two differ, none are taken for equal."""
    order = np.lexsort((doc, key))
    head = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    group = np.flatnonzero(head)[np.cumsum(head) - 1]
    again = np.flatnonzero(~head)
    if len(again):
        mine, lead = order[again], order[group[again]]
        if (size[mine] != size[lead]).any():
            return order, np.arange(len(order))
        n = size[mine]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if (codes[np.repeat(at[mine], n) + step] != codes[np.repeat(at[lead], n) + step]).any():
            return order, np.arange(len(order))
    return order, group


def _pack(seg: np.ndarray, words: list[bytes]) -> bytes:
    """A shard's segments, compressed: how many, their fields one after another, their words."""
    flat = b"".join([np.int64(len(seg)).tobytes(), *(np.ascontiguousarray(seg[f]).tobytes() for f in _SEG.names), b" ".join(words)])
    return zstandard.ZstdCompressor(level=3).compress(flat)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Segments and the codes of their words."""
    flat = zstandard.ZstdDecompressor().decompress(blob)
    n, at = int(np.frombuffer(flat, np.int64, 1)[0]), 8
    seg = np.zeros(n, _SEG)
    for f in _SEG.names:
        seg[f] = np.frombuffer(flat, _SEG[f], n, at)
        at += n * _SEG[f].itemsize
    return seg, _words(np.frombuffer(flat + b"\n", np.uint8)[at:])[2]


def _cut(frames: Iterator[pd.DataFrame], shards: int, window: int) -> Iterator[pd.DataFrame]:
    """Segments by shard, and the repeats that are known already, each as packed bytes."""
    for b in frames:
        docs, rows = b["doc_id"].to_numpy(np.int64), (b["row"].to_numpy(np.int64) & 0xFFFFFFFF).astype(np.uint32)
        for first, raws in hashing.steps(t.encode("utf-8", "replace") for t in b["text"]):
            part = slice(first, first + len(raws))
            seg, least, codes, at, byte0, byte1 = _segments(raws, docs[part], rows[part], window)
            if not len(seg):
                continue
            size = seg["n"].astype(np.int64) + window - 1
            key = hashing.Ranges(hashing.mixed(codes))(at, at + size)
            order, group = _copies(key, seg["doc"], codes, at, size)
            repeat = seg["doc"][order] > seg["doc"][order[group]]
            later = order[repeat]
            out_shard, out_kind, out_blob = [], [], []
            if len(later):
                known = np.zeros(len(later), _CUT)
                for f in ("doc", "row", "at"):
                    known[f] = seg[f][later]
                known["end"] = known["at"] + size[later]
                out_shard.append(int(least[0] % np.uint64(shards)))
                out_kind.append(1)
                out_blob.append(zstandard.ZstdCompressor(level=3).compress(known.tobytes()))
            stay = np.sort(order[~repeat])
            shard = (least[stay] >> np.uint64(20)) % np.uint64(shards)
            by = np.argsort(shard, kind="stable")
            stay, shard = stay[by], shard[by]
            edge = np.append(np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])), len(shard))
            flat = b"\n".join(raws)
            words = [flat[s:e] for s, e in zip(byte0[stay].tolist(), byte1[stay].tolist(), strict=True)]
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                out_shard.append(int(shard[s]))
                out_kind.append(0)
                out_blob.append(_pack(seg[stay[s:e]], words[s:e]))
            yield pd.DataFrame({"shard": out_shard, "kind": out_kind, "blob": out_blob})


def search(seg: np.ndarray, codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Repeats among one shard's segments, as (doc, row, first word, end)."""
    size = seg["n"].astype(np.int64) + window - 1
    begin = np.cumsum(size) - size
    g = np.append(_grams(codes), np.full(2, np.iinfo(np.uint64).max, np.uint64))
    own = np.arange(len(codes)) - np.repeat(begin, size)
    g[own > np.repeat(size, size) - _GRAM] = np.iinfo(np.uint64).max
    least = np.minimum.reduceat(g, begin)
    # a window can only recur where its minimiser does, in another document
    order = np.argsort(least, kind="stable")
    head = np.flatnonzero(np.concatenate([[True], least[order][1:] != least[order][:-1]]))
    low, high = np.minimum.reduceat(seg["doc"][order], head), np.maximum.reduceat(seg["doc"][order], head)
    keep = np.sort(order[np.repeat(low < high, np.diff(np.append(head, len(order))))])
    if not len(keep):
        return np.zeros(0, _CUT)
    seg, size, begin = seg[keep], size[keep], begin[keep]
    key = hashing.Ranges(hashing.mixed(codes))(begin, begin + size)
    order, group = _copies(key, seg["doc"], codes, begin, size)
    is_head = group == np.arange(len(group))
    text_of = np.empty(len(seg), np.int64)
    text_of[order] = np.cumsum(is_head) - 1
    lead = order[is_head]  # of each distinct segment the one with the smallest doc_id
    n = size[lead]
    place = np.cumsum(n + 1) - (n + 1)  # a separator after each
    text = np.zeros(int((n + 1).sum()), np.int64)
    spot = np.repeat(place, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    values = codes[np.repeat(begin[lead], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    alphabet, symbols = np.unique(values, return_inverse=True)
    text[spot] = symbols + 1
    ids, rank = np.unique(seg["doc"][lead], return_inverse=True)
    index = FMIndex(text, len(alphabet) + 1, np.repeat(rank, n + 1))
    wins = seg["n"][lead].astype(np.int64)
    win0 = np.cumsum(wins) - wins
    at = np.repeat(place, wins) + np.arange(wins.sum()) - np.repeat(win0, wins)
    lo, hi, matched = index.statistics(text, at, window)
    first = np.repeat(seg["doc"][lead], wins)
    hit = np.flatnonzero(matched >= window)
    if len(hit):
        ranges, back = np.unique(lo[hit], return_inverse=True)
        ends = np.zeros(len(ranges), np.int64)
        ends[back] = hi[hit]
        pairs = np.stack([ranges, ends], axis=1).ravel()
        least = np.minimum.reduceat(np.append(index.owner, index.owner[:1]), pairs)[::2]
        first[hit] = ids[least[back]]
    # every segment's windows against the first document that has them; one more, never flagged, ends a segment
    w = seg["n"].astype(np.int64)
    w0 = np.cumsum(w + 1) - (w + 1)
    k = np.arange((w + 1).sum()) - np.repeat(w0, w + 1)
    flag = np.zeros(len(k), bool)
    real = k < np.repeat(w, w + 1)
    flag[real] = (first[np.repeat(win0[text_of], w) + k[real]]) < np.repeat(seg["doc"], w)
    s, e = hashing.runs(flag)
    of = np.searchsorted(w0, s, side="right") - 1
    out = np.zeros(len(s), _CUT)
    out["doc"], out["row"] = seg["doc"][of], seg["row"][of]
    out["at"] = seg["at"][of] + (s - w0[of])
    out["end"] = seg["at"][of] + (e - w0[of]) + window - 1
    return out


def _shard(frames: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by shard."""
    key, segs, codes = None, [], []

    def rows(cut: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": cut["doc"], "row": cut["row"].astype(np.int64), "at": cut["at"].astype(np.int32), "end": cut["end"].astype(np.int32)})

    def close() -> Iterator[pd.DataFrame]:
        if segs:
            found = search(np.concatenate(segs), np.concatenate(codes), window)
            segs.clear()
            codes.clear()
            if len(found):
                yield rows(found)

    for b in frames:
        for shard, kind, blob in zip(b["shard"], b["kind"], b["blob"], strict=True):
            if shard != key:
                yield from close()
                key = shard
            if kind:
                yield rows(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), _CUT))
                continue
            seg, words = _unpack(blob)
            segs.append(seg)
            codes.append(words)
    yield from close()


def repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, name: str = "repeats") -> DataFrame:
    """All columns of ``docs`` and ``repeats``: intervals (at, end) of words, which may touch or overlap,
    that windows cover whose word sequence also starts in a document with a smaller doc_id.

    Null, empty and short texts have none (null list).  Rows with a null doc_id keep all
    and make nobody else a repeat.  Rows that share a doc_id never count against each other.
    Whole texts count, however long.  Words are compared by 64 bits of their hash, windows by all
    13 of them.  A column of ``docs`` named like the result is replaced; any other name may occur.
    """
    if not _GRAM <= window <= 16:
        raise ValueError("a window has 3 to 16 words")
    spark = docs.sparkSession
    prepare(spark)
    doc, body = F.col("doc_id").cast("long"), F.col(text)
    row = F.xxhash64(body).bitwiseAND(F.lit(0xFFFFFFFF))
    held = docs.agg(F.sum(F.octet_length(body).cast("long"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // SHARD_BYTES))
    src = docs.where(doc.isNotNull() & body.isNotNull()).select(doc.alias("doc_id"), row.alias("row"), body.alias("text"))
    dealt = src.mapInPandas(lambda f: _cut(f, shards, window), "shard int, kind int, blob binary").repartition("shard").sortWithinPartitions("shard")
    cuts = materialize(dealt.mapInPandas(lambda f: _shard(f, window), "doc_id long, row long, at int, end int"), "repeats")
    lists = cuts.groupBy("doc_id", "row").agg(F.collect_list(F.struct("at", "end")).alias(name))
    return attach(docs, {"doc_id": doc, "row": row}, lists)


def kept_words(text: str | None, cuts) -> tuple[list[bytes], int]:
    """The words that stay, and how many there were."""
    words = (text or "").encode("utf-8", "replace").split()
    if cuts is None or not len(cuts):
        return words, len(words)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, [c["at"] for c in cuts], 1)
    np.add.at(drop, [c["end"] for c in cuts], -1)
    stay = (np.cumsum(drop)[:-1] == 0).tolist()
    return [w for w, s in zip(words, stay, strict=True) if s], len(words)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def digest(text: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        rows = []
        for t, c in zip(text, cuts, strict=True):
            kept, n = kept_words(t, c)
            rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    return found.select("doc_id", digest("text", "repeats").alias("d")).select("doc_id", "d.*")


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13),
x AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS g FROM p),
f AS (SELECT g, min(doc_id) AS least FROM x GROUP BY g),
hit AS (SELECT x.doc_id, x.i FROM x JOIN f USING (g) WHERE f.least < x.doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM hit CROSS JOIN range(0, 13) AS t(k)),
each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM w),
kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(e.x, ' ' ORDER BY e.pos) AS t
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
