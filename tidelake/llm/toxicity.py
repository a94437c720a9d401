"""Toxicity: a counterfactually regularised classifier over whole texts.

Features are hashed words and word beginnings that a text holds.  The model is
a logistic regression on the features that tell the labels apart best.  In
labelled texts that name a group of people, the group's name is swapped for
another of its kind; the fit pays for every change of the score that the swap
makes, so group names alone cannot carry a verdict, while real evidence can.

Names come from lists in four languages, and from the labelled texts: words that
many of them hold and whose presence says nothing of the label are taken for
names that a corpus mentions neutrally, and are swapped for one another.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashing
from .common import discard, materialize, prepare, table

#: Kinds of group names (English, German, French, Spanish); a swap stays within a kind.
GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("female", "male"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "transgender", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "american", "mexican", "chinese", "indian", "turkish", "russian", "polish"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "autistic"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "katholiken", "protestanten"),
    ("frau", "mann", "mädchen", "junge"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("schwul", "lesbisch", "bisexuell", "heterosexuell", "homosexuell"),
    ("türken", "araber", "afrikaner", "russen", "polen", "chinesen", "deutsche", "franzosen"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "catholiques", "protestants"),
    ("femme", "homme", "fille", "garçon"),
    ("femmes", "hommes", "filles", "garçons"),
    ("homosexuel", "lesbienne", "bisexuel", "hétérosexuel"),
    ("arabes", "africains", "russes", "polonais", "chinois", "allemands", "turcs"),
    ("immigrés", "réfugiés", "étrangers"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    ("mujer", "hombre", "niña", "niño"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("árabes", "africanos", "rusos", "polacos", "chinos", "alemanes", "turcos", "mexicanos"),
    ("inmigrantes", "refugiados", "extranjeros"),
)
#: Learnt names: at most so many, in kinds of so many; each in this share of the labelled texts at least, and this
#: near to the same share of both labels (in standard deviations).
NAMES, KIND, OFTEN, NEUTRAL = 64, 8, 0.01, 1.0


BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
#: Labelled rows of each class that the fit reads at most (hash order decides which).
SAMPLE = 6000
#: Features of the model at most.
FEATURES = 1536
#: Documents of the rarer class that a feature needs.
LEAST = 3
#: Weights of the penalties on size and on counterfactual change.
RIDGE, SWAPS = 2e-4, 1.0
THRESHOLD = 0.3

_WORD = np.zeros(256, bool)
_WORD[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)]] = True


def features(texts: list[str | None], lut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, distinct and in order.  ``lut`` maps hashed features to model features, -1 to none."""
    docs, feats = [], []
    for first, raws in hashing.steps((t or "").lower().encode("utf-8", "replace") for t in texts):
        raw, begin = hashing.join(raws)
        start, end = hashing.runs(_WORD[raw])
        if not len(start):
            continue
        doc = np.searchsorted(begin, start, side="right") - 1
        of = hashing.Ranges(raw)
        n = end - start
        for k in (0, *PREFIXES):
            at = slice(None) if k == 0 else n > k
            s = start[at]
            h = (of(s, end if k == 0 else s + k) + np.uint64(k * 0x2545F4914F6CDD1D & (2**64 - 1))) >> np.uint64(64 - BITS)
            d = doc[at]
            f = h.astype(np.int64)
            if lut is not None:
                f = lut[f].astype(np.int64)
                d, f = d[f >= 0], f[f >= 0]
            docs.append(d + first)
            feats.append(f)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique((np.concatenate(docs) << 32) | np.concatenate(feats))
    return both >> 32, both & 0xFFFFFFFF


class Swaps:
    """Exchanges every name of the given kinds for another of its kind."""

    def __init__(self, kinds: Iterable[Iterable[str]] = GROUPS):
        self.of: dict[str, list[str]] = {}
        for kind in kinds:
            kind = list(kind)
            for i, t in enumerate(kind):
                if others := [*kind[i + 1 :], *kind[:i]]:
                    self.of.setdefault(t, others)
        self.word = re.compile(r"[^\W_]+")

    def __call__(self, text: str) -> str | None:
        """The text, lower-cased, with every name exchanged, or None if it has none."""
        low, n = text.lower(), 0

        def other(m: re.Match) -> str:
            nonlocal n
            if (them := self.of.get(m[0])) is None:
                return m[0]
            n += 1
            return them[len(low) % len(them)]

        out = self.word.sub(other, low)
        return out if n else None


def learnt(counts: list[tuple[str, int, int]], texts: int, toxic: int) -> list[tuple[str, ...]]:
    """Kinds of names that the labelled texts mention neutrally, from (word, texts with it, toxic ones among them).

    The most frequent of the words that are neutral, those of like frequency as one kind."""
    known = {t for g in GROUPS for t in g}
    chosen = []
    for word, n, n1 in counts:
        share = toxic / max(texts, 1)
        spread = math.sqrt(max(n * share * (1 - share) * max(texts - n, 1) / max(texts, 1), 1e-9))
        if n >= max(OFTEN * texts, LEAST) and abs(n1 - n * share) <= NEUTRAL * spread and word not in known:
            chosen.append((-n, word))
    words = [w for _, w in sorted(chosen)[:NAMES]]
    kinds = [tuple(words[i : i + KIND]) for i in range(0, len(words), KIND)]
    return [k for k in kinds if len(k) > 1]


@dataclass
class Model:
    lut: np.ndarray  # int16: hashed feature to model feature or -1
    weights: np.ndarray
    bias: float
    swapped: int = 0  # labelled texts that had a counterfactual

    def score(self, texts: list[str | None]) -> np.ndarray:
        d, f = features(texts, self.lut)
        z = np.bincount(d, self.weights[f], minlength=len(texts)) + self.bias if len(d) else np.full(len(texts), self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def choose(count: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """lut of the features that tell the labels apart best; ``count`` is (label, hashed feature) texts."""
    p1, p0 = (count[1] + 0.5) / (n1 + 1), (count[0] + 0.5) / (n0 + 1)
    pooled = (count[1] + count[0] + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / np.sqrt(pooled * (1 - pooled) * (1 / (n1 + 1) + 1 / (n0 + 1)))
    z[count.sum(axis=0) < LEAST] = 0
    best = np.argsort(-np.abs(z), kind="stable")[:FEATURES]
    best = np.sort(best[np.abs(z[best]) >= 3.0])
    lut = np.full(1 << BITS, -1, np.int16)
    lut[best] = np.arange(len(best))
    return lut


def fit(texts: list[str], labels: np.ndarray, class_weight: tuple[float, float] = (1.0, 1.0), swaps: float = SWAPS, ridge: float = RIDGE, kinds: Iterable[Iterable[str]] = GROUPS) -> Model:
    """Fit on plain texts (for tests and small corpora); ``train`` feeds the same routine from executors."""
    y, exchange = np.asarray(labels), Swaps(kinds)
    have = [np.unique(features([t])[1]) for t in texts]
    other = [None if (s := exchange(t)) is None else np.unique(features([s])[1]) for t in texts]
    count = np.zeros((2, 1 << BITS), np.int32)
    for f, c in zip(have, y, strict=True):
        count[int(c), f] += 1
    lut = choose(count, int((y == 0).sum()), int((y == 1).sum()))
    mine = lambda f: None if f is None else lut[f][lut[f] >= 0]
    return _fit(lut, [mine(f) for f in have], [mine(f) for f in other], y, class_weight, swaps, ridge)


class _Rows:
    """Sparse rows of ones."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], minlength=self.n)

    def sum(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], minlength=self.width)


def _fit(lut: np.ndarray, have: list[np.ndarray], other: list[np.ndarray | None], y: np.ndarray, class_weight: tuple[float, float], swaps: float, ridge: float) -> Model:
    """``have`` and ``other`` hold model features."""
    if not (y == 1).any():
        return Model(np.full(1 << BITS, -1, np.int16), np.zeros(0), -500.0)
    width = int(lut.max()) + 1
    x = _Rows(have, width)
    changed = [(h, o) for h, o in zip(have, other, strict=True) if o is not None]
    here, there = _Rows([c[0] for c in changed], width), _Rows([c[1] for c in changed], width)
    cw = np.where(y == 1, class_weight[1], class_weight[0])
    cw = cw / cw.sum()
    w, b = np.zeros(width), float(np.log((cw[y == 1].sum() + 1e-9) / (cw[y == 0].sum() + 1e-9)))
    # Accelerated gradient steps; the step comes from a bound on the curvature, so there is nothing to tune.
    probe, top = np.ones(width + 1), 1.0
    for _ in range(20):
        u = (x.dot(probe[:-1]) + probe[-1]) * cw
        probe = np.append(x.sum(u), u.sum())
        top = float(np.linalg.norm(probe)) or 1.0
        probe /= top
    bound = 0.3 * top + ridge
    if changed:
        bound += 2 * swaps * max(len(np.setxor1d(h, o)) for h, o in changed)
    tw, tb = w.copy(), b
    for t in range(1, 601):
        r = (1 / (1 + np.exp(-np.clip(x.dot(tw) + tb, -60, 60))) - y) * cw
        gw = x.sum(r) + ridge * tw
        if changed:
            moved = 2 * swaps / len(changed) * (here.dot(tw) - there.dot(tw))
            gw += here.sum(moved) - there.sum(moved)
        nw, nb = tw - gw / bound, tb - float(r.sum()) / bound
        m = (t - 1) / (t + 2)
        tw, tb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return Model(lut, w.astype(np.float64), float(b), len(changed))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, swaps: float = SWAPS) -> Model:
    """Fit on at most ``sample`` labelled rows of each class, none of them held out.

    Only texts and ``labels.toxic`` are read.  A document with several labels counts as
    toxic if one says so; null labels, ids and texts teach nothing, and of texts that share an
    id the least teaches.  Whole texts teach, however long.  Without a toxic row (an empty table
    too) the model scores 0 everywhere.  Other columns of both tables are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for c in (0, 1):
        part = known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = spark.createDataFrame(chosen.toPandas(), "doc_id long, toxic int")  # 2 * sample rows at most
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    # one text an id; from here on all work is bounded by the sample
    texts = materialize(read.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")), "labelled")
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    word = texts.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]{3,}"), F.lit(0)))).alias("word"))
    often = word.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("n1")).where(F.col("n") >= max(OFTEN * (n0 + n1), LEAST))
    often = often.orderBy(F.desc("n"), "word").limit(64 * NAMES).collect()
    kinds = [*GROUPS, *learnt([tuple(r) for r in often], n0 + n1, n1)]

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros((2, 1 << BITS), np.int32)
        for b in batches:
            for t, c in zip(b["text"], b["toxic"], strict=True):
                count[int(c), features([t])[1]] += 1
        f = np.flatnonzero(count.any(axis=0))
        yield pd.DataFrame({"f": f, "n0": count[0][f], "n1": count[1][f]})

    sums = texts.select("text", "toxic").mapInPandas(tally, "f int, n0 int, n1 int").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = sums.where(F.col("n0") + F.col("n1") >= LEAST).toPandas()  # 2 ** BITS rows at most
    count = np.zeros((2, 1 << BITS), np.int64)
    for c, name in enumerate(("n0", "n1")):
        count[c, sums["f"].to_numpy(np.int64)] = sums[name].to_numpy(np.int64)
    lut = choose(count, n0, n1)
    shared = spark.sparkContext.broadcast(lut)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exchange = Swaps(kinds)
        for b in batches:
            rows = []
            for t, c in zip(b["text"], b["toxic"], strict=True):
                s = exchange(t)
                rows.append((int(c), *(None if x is None else features([x], shared.value)[1].astype(np.uint16).tobytes() for x in (t, s))))
            yield pd.DataFrame(rows, columns=["toxic", "have", "other"])

    # 2 * sample rows of FEATURES numbers of two bytes at most
    got = texts.select("text", "toxic").mapInPandas(run, "toxic int, have binary, other binary").collect()
    got.sort(key=lambda r: (r["toxic"], r["have"], r["other"] or b""))  # the fit must not depend on the order of tasks
    have = [np.frombuffer(r["have"], np.uint16).astype(np.int64) for r in got]
    other = [None if r["other"] is None else np.frombuffer(r["other"], np.uint16).astype(np.int64) for r in got]
    y = np.fromiter((r["toxic"] for r in got), np.int64, len(got))
    weight = tuple(max(1.0, sizes.get(c, 0) / sample) for c in (0, 1))
    discard(texts)
    return _fit(lut, have, other, y, weight, swaps, RIDGE)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1); null and empty texts get the score of no evidence.

    Row by row, whole texts: repeated rows and equal texts get equal scores, an empty table gives no rows, a
    column named like the result is replaced, and other names may clash with nothing.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((model.lut, model.weights, model.bias))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = Model(*shared.value)
        for part in parts:
            yield pd.Series(held.score([None if t is None else t for t in part]), dtype="float64")

    return docs.withColumn(name, F.pandas_udf(run, "double")(F.col(text)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score(docs, model, name="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
