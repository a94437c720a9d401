"""Best-fit packing: tokenised documents into sequences of at most a given length.

Lengths are whole numbers up to the capacity, so all that the packer must know
is how many pieces have each length: at most ``capacity`` counts, however large
the corpus.  On those counts it first applies Martello and Toth's dominance
rule: a set of up to three that holds the largest open piece and dominates every
other set with that piece is fixed for good and leaves the instance.  Best-fit decreasing
packs what remains.  The plan (a few thousand ranges of ranks at most) goes to
the executors, where each piece finds its place by its rank among the pieces of
its length; ranks come from two-level counts, so no length, however common, is
ranked by one task.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, prepare, table

assert sys.byteorder == "little" and array("I").itemsize == 4  # ids are packed as the machine has them

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Rows of one length that one task ranks, about.
RANK_ROWS = 16384
#: Distinct pre-tokens a worker remembers, and as many of the ones before; bounds its memory.
CACHE_WORDS = 400_000

#: Longer chunks are encoded anew each time.
CACHE_CHARS = 64
#: Characters of text whose unknown pre-tokens are encoded together, about, and words encoded as one text.
TOGETHER = 1 << 18
JOINED = 1000

# The byte-level pre-tokeniser's rule (public); on texts of Latin letters these classes say what its classes say.
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_DIGIT = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
# Letters come first, as most are: nothing that begins with them or a space and them fits the rule's endings.
_PRE = re.compile(f" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_ODD = re.compile(f"[^{_SPACE}\x21-\x7e\u00a1-\u024f]")
_WORD = re.compile(f" [{_LETTER}]{{1,{CACHE_CHARS - 1}}}")
# Other texts are cut before a space between two characters that are no white space: by that rule a pre-token
# begins there whatever stands around it, so the ids of the chunks, one after another, are the ids of the text.
_CUT = re.compile(r"(?<=\S)(?= \S)")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """Token ids as little-endian uint32 bytes; pre-tokens met before come from a bounded memory."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)  # bytes of text in each id: a byte-level token has a character for each
        for token, k in vocab.items():
            self.sizes[k] = len(token)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the last full memory; what is still in use moves back

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; pre-tokens that are not known yet are encoded together, whichever text they are of."""
        found: list[list] = []
        gaps: list[tuple[list, list[str], list[int]]] = []  # whose ids, pre-tokens, and places where those are not known
        new: set[str] = set()
        for text in texts:
            parts = _CUT.split(text) if _ODD.search(text) or any(s in text for s in self.special) else _PRE.findall(text)
            got = [*map(self.known.get, parts)]
            if missing := got.count(None):
                at, k = [], -1
                for _ in range(missing):
                    k = got.index(None, k + 1)
                    at.append(k)
                new.update([parts[k] for k in at])
                gaps.append((got, parts, at))
            found.append(got)
        if new:
            learnt = self.learn(new)
            for got, parts, at in gaps:
                for k in at:
                    got[k] = learnt[parts[k]]
        return [b"".join(got) for got in found]

    def learn(self, new: set[str]) -> dict[str, bytes]:
        """The ids of parts that are not known; those that are not too long are known from now on."""
        out: dict[str, bytes] = {}
        words, rest = [], []
        for p in new:
            if (ids := self.before.get(p)) is not None:
                out[p] = ids
            else:
                (words if _WORD.fullmatch(p) else rest).append(p)
        for k in range(0, len(words), JOINED):
            some = words[k : k + JOINED]
            if ids := self._joined(some):
                out |= ids
            else:
                rest += some
        for p, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            out[p] = array("I", e.ids).tobytes()
        if len(self.known) + len(out) > CACHE_WORDS:
            self.known, self.before = {}, self.known
        self.known |= out
        for p in rest:
            if len(p) > CACHE_CHARS:
                del self.known[p]
        return out

    def _joined(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words that begin with a space and go on with letters: in one text each is a pre-token again, and its
        ids are those whose bytes it spans.  None where the ids don't end with the words."""
        text = "".join(words)
        if any(s in text for s in self.special):
            return {}
        ids = np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.sizes[ids])
        words_end = np.cumsum([len(w.encode()) for w in words])
        at = np.searchsorted(ends, words_end)
        if not len(ids) or at[-1] != len(ids) - 1 or (ends[at] != words_end).any():
            return {}
        raw, at = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
        return {w: raw[i:j] for w, i, j in zip(words, at[:-1], at[1:], strict=True)}


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _together(docs: pd.Series, texts: pd.Series) -> Iterator[tuple[list, list[str]]]:
    """Rows in groups of some TOGETHER characters, one row at least; a null text is empty."""
    ids, some, size = [], [], 0
    for doc, t in zip(docs, texts, strict=True):
        ids.append(doc)
        some.append(t or "")
        size += len(some[-1])
        if size >= TOGETHER:
            yield ids, some
            ids, some, size = [], [], 0
    if some:
        yield ids, some


def tokenize(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32 (and ids).

    Documents longer than ``capacity`` (end token included) are cut into pieces of
    ``capacity``, of which the first may be shorter; a null text counts as empty and
    is one piece, the end token.
    """
    prepare(docs.sparkSession)
    path = path or tokenizer_path()
    end = np.asarray([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            rows: list[tuple] = []
            for docs, texts in _together(b["doc_id"], b["text"]):
                for doc, ids in zip(docs, enc.encode_all(texts), strict=True):
                    raw = ids + end
                    first = len(raw) % step or step
                    at, k = 0, 0
                    while at < len(raw):
                        piece = raw[at : first if not k else at + step]
                        rows.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece), *([np.frombuffer(piece, "<u4").astype(np.int32)] if with_ids else [])))
                        at, k = at + len(piece), k + 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return src.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


class Plan:
    """Bins by group: every bin of a group holds the same lengths in the same order."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: list[tuple[tuple[int, int, int], ...]] = []  # ((length, offset, how many in a row), ...)
        self.counts: list[int] = []

    def add(self, runs: Iterable[tuple[int, int]], count: int) -> None:
        at, group = 0, []
        for length, times in runs:
            group.append((length, at, times))
            at += length * times
        assert at <= self.capacity and count > 0
        self.groups.append(tuple(group))
        self.counts.append(count)

    def ranges(self) -> pd.DataFrame:
        """length, first rank, first sequence, offset: ranks from ``rank`` on fill the sequences from ``sequence`` on."""
        rows, used, sequence = [], {}, 0
        for group, n in zip(self.groups, self.counts, strict=True):
            for length, at, times in group:
                for k in range(times):
                    rank = used.get(length, 0)
                    rows.append((length, rank, sequence, at + k * length))
                    used[length] = rank + n
            sequence += n
        return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def _three(left: dict[int, int], big: int, best: int, room: int) -> tuple[int, ...] | None:
    """What beside ``big`` and ``best``, the largest piece that fits with it, makes a set that dominates all others with
    ``big``: () for nothing more, (third,) for one more piece, None where no such set is known.

    Only where no three pieces fit beside the big one.  One piece as large as any two that fit together dominates
    them; otherwise the best and the largest third piece do, if no two pieces larger than the third fit together.
    """
    free = Counter(left)
    free[big] -= 1
    sizes = sorted(n for n in free if 0 < n <= room and free[n] > 0)
    smallest = [n for n in sizes[:3] for _ in range(min(free[n], 3))][:3]
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    top, hi = 0, len(sizes) - 1  # the largest sum of two that fit
    for lo, n in enumerate(sizes):
        while hi > lo and sizes[hi] + n > room:
            hi -= 1
        if hi < lo or hi == lo and (free[n] < 2 or 2 * n > room):
            break
        top = max(top, sizes[hi] + n)
    if best >= top:
        return ()
    free[best] -= 1
    third = max((n for n in sizes if free[n] > 0 and n <= room - best), default=0)
    if not third:
        return None
    larger = [n for n in sizes if n > third and free[n] > 0][:2]
    larger = [n for n in larger for _ in range(min(free[n], 2))][:2]
    return (third,) if len(larger) < 2 or sum(larger) > room else None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``count`` pieces of each ``length``: dominance reduction, then best-fit decreasing."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("a length is outside 1..capacity")
    out, rest = Plan(capacity), {}
    for big in sorted(left, reverse=True):
        while count := left.get(big, 0):
            room = capacity - big
            smaller = sorted(n for n in left if left[n] > (n == big))  # other pieces than the one at hand
            if not smaller or smaller[0] > room:  # nothing fits beside it: alone it dominates
                out.add([(big, 1)], count if not smaller or smaller[0] != big else count)
                left.pop(big)
                continue
            best = max(n for n in smaller if n <= room)
            low = smaller[0]
            second = low if left[low] - (low == big) > 1 else (smaller[1] if len(smaller) > 1 else capacity)
            # one more piece at most fits, or one fills the room to the brim: the largest that fits dominates
            if best == room or low + second > room:
                times = count // 2 if best == big else min(count, left[best])
                if times:
                    out.add([(big, 1), (best, 1)] if best != big else [(big, 2)], times)
                    for n in (big, best):
                        left[n] -= times
                        if not left[n]:
                            left.pop(n)
                    continue
            if (trio := _three(left, big, best, room)) is not None:
                lengths = Counter((big, best, *trio))
                times = min(left[n] // k for n, k in lengths.items())
                out.add(sorted(lengths.items(), reverse=True), times)
                for n, k in lengths.items():
                    left[n] -= times * k
                    if not left[n]:
                        left.pop(n)
                continue
            rest[big] = left.pop(big)
    # Best fit, decreasing: `open_` maps free room to bins [(runs, count)].
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}

    def put(runs, count, length, times, room):
        open_.setdefault(room - length * times, []).append(((*runs, (length, times)), count))

    for length in sorted(rest, reverse=True):
        count = rest[length]
        while count:
            fits = [r for r in open_ if r >= length]
            if fits:
                room = min(fits)
                runs, bins = open_[room].pop()
                if not open_[room]:
                    del open_[room]
            else:
                room, runs, bins = capacity, (), -(-count // (capacity // length))
            each = room // length
            full = min(bins, count // each)
            if full:
                put(runs, full, length, each, room)
            count -= full * each
            if full < bins:
                if 0 < count < each:
                    put(runs, 1, length, count, room)
                    count, full = 0, full + 1
                if full < bins and runs:
                    open_.setdefault(room, []).append((runs, bins - full))
    for groups in open_.values():
        for runs, bins in groups:
            out.add(runs, bins)
    return out


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``rank``: from 0, gapless among the pieces of a length, by (bucket, doc_id, piece).

    Rows that agree in all columns may swap their ranks; nothing tells them apart.
    """
    buckets = max(1, -(-rows // RANK_ROWS))
    cut = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = cut.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    order = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32")
    return (
        cut.withColumn("_r", F.row_number().over(order))
        .join(before.select("length", "_b", "_before"), ["length", "_b"])
        .withColumn("rank", F.coalesce("_before", F.lit(0)) + F.col("_r") - 1)
        .drop("_b", "_r", "_before")
    )


def pack(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece: the columns of tokenize(), sequence_id and offset.

    Sequences are gapless from offset 0.  An empty table gives no rows.  Repeated
    rows, doc_ids and texts are packed each for itself; extra columns are left out.
    """
    spark = docs.sparkSession
    pieces = materialize(tokenize(docs, text, path, capacity, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    ranges = plan(histogram, capacity).ranges()
    shift = max(histogram.values(), default=1).bit_length()
    if shift + capacity.bit_length() > 62:
        raise ValueError("too many pieces of one length")
    shared = spark.sparkContext.broadcast(
        ((ranges["length"].to_numpy(np.int64) << shift) | ranges["rank"].to_numpy(np.int64), ranges["rank"].to_numpy(np.int64), ranges["sequence"].to_numpy(np.int64), ranges["offset"].to_numpy(np.int64))
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, first, sequence, offset = shared.value
        r = rank.to_numpy(np.int64)
        k = np.searchsorted(keys, (length.to_numpy(np.int64) << shift) | r, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[k] + r - first[k], "offset": offset[k]})

    return ranked(pieces, sum(histogram.values())).withColumn("_p", place("length", "rank")).select(*pieces.columns, "_p.sequence_id", "_p.offset")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


