"""Secret scans: fixed patterns, and a randomness test battery for what they miss.

Candidates of the battery are long runs of key-like characters outside the
patterns' spans.  For each, an encoding is inferred (the smallest alphabet that
holds it); three tests then ask whether it looks like uniform draws from that
alphabet: a chi-squared test of symbol counts, a runs test about the median
symbol and a serial-correlation test.  A test that rejects randomness ends the
matter.  The evidence of what passes is the mean of four e-values, each with mean
1 at most where the token is ordinary text, and a mean of e-values is one under
any dependence: for each test, the density of its statistic under random draws
against one that is wider by the root of the token's length; and the likelihood
ratio of random draws to a text-like chain of character classes.  Both grow with
length, so short tokens must be clearer to count.  The e-values of all candidates
of the corpus go through one e-BH procedure, which holds the false-discovery rate
under any dependence: a first pass counts them by size (in a bounded number of
steps, rounded down), from which the least size that counts follows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table

#: Kind, pattern, group that is measured, least length of it; in the order that breaks ties.
BASE = (
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: Runs that the long form of a pattern must hold, where finding them is cheaper than all matches.
_LONG = {"hex": re.compile(r"[0-9a-f]{24,}"), "access": re.compile(r"AKIA[A-Z0-9]{16,}")}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Where a candidate that fails as a whole is split, and the least part that is tested.
_JOINTS = tuple(map(re.compile, (r"[^_-]+", r"[^/+]+", r"[^/_+-]+")))
LEAST = 20
#: Alphabets by which tokens are encoded, smallest first.
ALPHABETS = tuple(
    (n, {c: i for i, c in enumerate(a)})
    for n, a in (
        ("hex", "0123456789abcdef"),
        ("hex_upper", "0123456789ABCDEF"),
        ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
        ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
        ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
        ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
        ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    )
)
#: In ordinary text, a character's class follows the one before with this probability.
STAY = 0.85
#: A test rejects randomness below this p-value.
REJECT = 0.001
#: Share of false discoveries that the battery may make.
FDR = 0.001
#: Steps of a log e-value of 1 by which candidates are counted, and the last step.
STEPS, MOST_STEPS = 16, 1 << 14

KINDS = {k: i for i, (k, *_) in enumerate(BASE)} | {"random": len(BASE)}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns: leftmost, non-overlapping per kind, short ones dropped."""
    out = []
    for kind, pattern, group, least in BASE:
        for m in _LONG.get(kind, pattern).finditer(text):
            if len(m[group]) >= least:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS[s[2]]))


def _tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def looks_random(token: str) -> tuple[str, float] | None:
    """Encoding and log e-value against ordinary text, or None if a test rejects randomness."""
    body = token.rstrip("=")
    found = next(((name, a) for name, a in ALPHABETS if all(c in a for c in body)), None)
    if found is None or body.isdigit():
        return None  # numbers are ordinary
    name, alphabet = found
    x, n, k = [alphabet[c] for c in body], len(body), len(alphabet)
    counts: dict[int, int] = {}
    for v in x:
        counts[v] = counts.get(v, 0) + 1
    chi = sum(c * c for c in counts.values()) * k / n - n  # mean k - 1, variance 2 (k - 1) (n - 1) / n
    uniform = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    if _tail(max(0.0, uniform)) < REJECT:
        return None
    above = [2 * v >= k for v in x]
    up = sum(above)
    if not 0 < up < n:
        return None
    runs = 1 + sum(a != b for a, b in zip(above, above[1:], strict=False))
    mean = 1 + 2 * up * (n - up) / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    if spread <= 0 or _tail((runs - mean) / math.sqrt(spread)) < REJECT:
        return None
    m = sum(x) / n
    var = sum((v - m) ** 2 for v in x)
    if var == 0:
        return None
    serial = sum((a - m) * (b - m) for a, b in zip(x, x[1:], strict=False)) / var * math.sqrt(n)
    if _tail(serial) < REJECT:
        return None
    wide = math.log(n) / 2
    logs = [wide - z * z / 2 * (1 - 1 / n) for z in (uniform, (runs - mean) / math.sqrt(spread), serial)]
    shares = [0.0] * 4
    for c in alphabet:
        shares[_class(c)] += 1 / k
    classes = [_class(c) for c in body]
    logs.append(sum(math.log(shares[b] / (STAY if a == b else (1 - STAY) / 3)) for a, b in zip(classes, classes[1:], strict=False)))
    top = max(logs)
    return name, top + math.log(sum(math.exp(v - top) for v in logs) / len(logs))


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[float, int, int]]:
    """(log e-value, start, end) of all candidates that overlap no base span; -inf where a test rejects randomness."""
    tested, at, until = [], 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():  # both in order of start
            until = max(until, taken[at][1])
            at += 1
        if until > m.start():
            continue
        if (found := looks_random(m[0])) is not None:
            tested.append((found[1], m.start(), m.end()))
            continue
        tested.append((-math.inf, m.start(), m.end()))
        body = m[0].rstrip("=")
        done = bytearray(len(body))
        for joint in _JOINTS:  # the parts that an alphabet may hold, then the smallest
            for part in joint.finditer(body):
                s, e = part.span()
                if LEAST <= e - s < len(m[0]) and done.find(1, s, e) < 0:
                    found = looks_random(part[0])
                    tested.append((found[1] if found else -math.inf, m.start() + s, m.start() + e))
                    if found:
                        done[s:e] = b"\1" * (e - s)
    return tested


def step_of(gain: float) -> int:
    """The step, rounded down, by which a log e-value is counted; -1 for none."""
    return -1 if gain < 0 else min(int(gain * STEPS), MOST_STEPS)


def cutoff(counts: dict[int, int]) -> float:
    """The least log e-value that counts by e-BH at FDR, from how many candidates of the corpus stand at each step."""
    total, seen, least = sum(counts.values()), 0, math.inf
    for step in sorted((s for s in counts if s >= 0), reverse=True):
        seen += counts[step]
        if step / STEPS >= math.log(total / (FDR * seen)):
            least = step / STEPS
    return least


def tally(texts: Iterable[str | None], counts: dict[int, int]) -> None:
    """Adds the candidates of the texts to the counts by step."""
    for t in texts:
        if t:
            for gain, *_ in candidates(t, base_spans(t)):
                counts[step_of(gain)] = counts.get(step_of(gain), 0) + 1


def random_spans(text: str, taken: list[tuple[int, int, str]], least: float | None = None) -> list[tuple[int, int, str]]:
    """Spans that the battery adds to the base spans; ``least`` as for spans()."""
    tested = candidates(text, taken)
    if least is None:
        counts: dict[int, int] = {}
        for gain, *_ in tested:
            counts[step_of(gain)] = counts.get(step_of(gain), 0) + 1
        least = cutoff(counts)
    return [(s, e, "random") for gain, s, e in tested if gain >= least]


def spans(text: str | None, least: float | None = None) -> list[tuple[int, int, str]]:
    """All spans of a text in code points, by start, then kind; a null text has none.

    ``least`` is the corpus's cutoff(); without it the text is a corpus of its own.
    """
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + random_spans(text, base, least), key=lambda s: (s[0], KINDS[s[2]]))


def corpus_cutoff(docs: DataFrame, text: str = "text") -> float:
    """cutoff() of all texts of ``docs``; MOST_STEPS counts at most reach the driver."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        for b in batches:
            tally(b["text"], counts)
        yield pd.DataFrame({"step": list(counts), "n": list(counts.values())}, dtype="int64")

    sums = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInPandas(run, "step long, n long").groupBy("step").agg(F.sum("n").alias("n"))
    return cutoff({r["step"]: r["n"] for r in sums.collect()})


def scan(docs: DataFrame, text: str = "text", name: str = "secrets") -> DataFrame:
    """All columns of ``docs`` and ``secrets``: array of (start, end, kind), empty for clean, empty and null texts.

    Whole texts, however long; equal texts and repeated rows get equal results, an empty table gives no rows.
    Of spans with one start the kind as listed goes first.  Other columns are passed through; a column of
    ``docs`` named like the result is replaced.
    """
    least = corpus_cutoff(docs, text)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([[{"start": s, "end": e, "kind": k} for s, e, k in spans(t, least)] for t in part])

    found = F.pandas_udf(run, "array<struct<start: int, end: int, kind: string>>")
    return docs.withColumn(name, found(F.col(text)))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of secrets in its text (overlapping ones as one) replaced by the mark; null stays null.

    Whole texts, however long; equal texts stay equal, an empty table gives no rows, and all other columns, whatever
    their names, are passed through.
    """
    least = corpus_cutoff(docs, text)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: hide(t, mark, least), na_action="ignore")

    return docs.withColumn(text, F.pandas_udf(run, "string")(F.col(text)))


def hide(text: str, mark: str, least: float | None = None) -> str:
    out, at = [], 0
    for s, e, _ in spans(text, least):
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def listed(of):
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


__all__ = ["scan", "redact", "spans", "hide", "looks_random", "op7_secrets"]
