"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

All globs are packed one after another into the bits of a row of 64-bit words.
One step reads one byte of every URL of a batch: the state row is shifted by
one across word borders, new pattern starts are let in, and the result is
masked by the byte's row (Shift-And).  A wildcard is no state of its own: it
makes the state before it loop, on any byte (``**``) or on any byte but ``/``
(``*``).  A pattern fits if its last state is on after the URL's last byte.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table

#: (verdict, host and path prefix): a rule fits its host and all subdomains.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Words that mark unwanted hosts, for URLs that no rule fits, where they are a whole label or a part between hyphens.
BLOCK_WORDS = ("adult", "casino", "cheap-pills", "escort", "gambling", "porn", "spam", "viagra", "warez", "xxx")
#: URLs a step holds at once, so that a batch's state stays small; and so few that each is read to its end alone.
STEP_ROWS, ALONE = 16384, 8


@dataclass
class Automaton:
    """Globs packed into multiword Shift-And masks."""

    starts: np.ndarray  # words: bits that a match may begin in
    masks: np.ndarray  # 256 x words: states that may be entered on a byte
    loops: np.ndarray  # 256 x words: states that may stay on a byte
    ends: list[tuple[int, int]]  # (word, bit) of each glob's last state
    final: int  # last states that any byte keeps, as one number

    @classmethod
    def build(cls, globs: Iterable[str]) -> Automaton:
        globs = list(globs)
        states: list[tuple[int | None, str | None]] = []  # (byte that enters, loop kind)
        starts, ends = [], []
        for g in globs:
            starts.append(len(states))
            states.append((None, None))  # on before the first byte only
            raw, i = g.encode(), 0
            while i < len(raw):
                if raw[i : i + 1] == b"*":
                    n = 2 if raw[i : i + 2] == b"**" else 1
                    states[-1] = (states[-1][0], "any" if n == 2 or states[-1][1] == "any" else "part")
                    i += n
                else:
                    states.append((raw[i], None))
                    i += 1
            ends.append(len(states) - 1)
        final = sum(1 << e for e in ends if states[e][1] == "any")
        width = max(1, -(-len(states) // 64))
        row = lambda: np.zeros(width, np.uint64)
        start, masks, loops = row(), np.zeros((256, width), np.uint64), np.zeros((256, width), np.uint64)
        bit = lambda k: (k // 64, np.uint64(1 << (k % 64)))
        for k in starts:
            w, b = bit(k)
            start[w] |= b
        for k, (enter, loop) in enumerate(states):
            w, b = bit(k)
            if enter is not None:
                masks[enter, w] |= b
            if loop:
                loops[:, w] |= b
                if loop == "part":
                    loops[ord("/"), w] &= ~b
        return cls(start, masks, loops, [divmod(k, 64) for k in ends], final)

    def match(self, urls: list[bytes]) -> np.ndarray:
        """Boolean (urls x globs).  Work is the sum of the URLs' lengths: longer URLs go on alone."""
        out = np.zeros((len(urls), len(self.ends)), bool)
        lengths = np.fromiter((len(u) for u in urls), np.int64, len(urls))
        order = np.argsort(-lengths, kind="stable")
        for at in range(0, len(urls), STEP_ROWS):
            part = order[at : at + STEP_ROWS]
            n = lengths[part]
            flat = np.frombuffer(b"".join(urls[i] for i in part), np.uint8)
            begin = np.concatenate([[0], np.cumsum(n)[:-1]])
            state = np.repeat(self.starts[None, :], len(part), axis=0)
            settled = ~np.frombuffer(self.final.to_bytes(8 * len(self.starts), "little"), np.uint64)
            rows = np.flatnonzero(n > 0)  # what is not read to its end, longest first
            t = 0
            while len(rows) > ALONE:
                now = state[rows]
                byte = flat[begin[rows] + t]
                moved = now << np.uint64(1)
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
                now = (moved & self.masks[byte]) | (now & self.loops[byte])
                state[rows] = now
                t += 1
                rows = rows[: np.searchsorted(-n[rows], -t)]
                if t % 8 == 0:  # where only last states are on, no byte changes anything
                    rows = rows[(state[rows] & settled).any(axis=1)]
            for i in rows.tolist():
                state[i] = self._alone(state[i], flat[begin[i] + t : begin[i] + n[i]].tobytes())
            for g, (w, b) in enumerate(self.ends):
                out[part, g] = (state[:, w] >> np.uint64(b)) & np.uint64(1) != 0
        return out


    def _alone(self, state: np.ndarray, rest: bytes) -> np.ndarray:
        """The state after the rest of one URL, its words as one number."""
        number = lambda x: int.from_bytes(x.tobytes(), "little")
        masks, loops, now, other = [number(m) for m in self.masks], [number(m) for m in self.loops], number(state), ~self.final
        for byte in rest:
            if not now & other:
                break
            now = (now << 1) & masks[byte] | now & loops[byte]
        return np.frombuffer(now.to_bytes(8 * len(state), "little"), np.uint64)


def rule_globs(rule: str) -> list[str]:
    """A rule as globs over host + path: the host itself, and every subdomain of it."""
    return [f"{rule}**", f"*.{rule}**"]


def word_globs(word: str) -> list[str]:
    """Hosts with the word as a label or as a part of one between hyphens, with any path."""
    return [f"{before}{word}{after}" for before in ("", "*.", "*-") for after in ("/**", ".*/**", "-*/**")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column) -> Column:
    """The host as globs see it: no user, port or closing dots, and no letters, digits, dots or hyphens hidden by percent signs."""
    h = F.regexp_replace(host, "^.*@", "")
    for code in (*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x2D, 0x2E):
        h = F.replace(h, F.lit(f"%{code:02x}"), F.lit(chr(code).lower()))
    return F.regexp_replace(F.regexp_replace(h, ":[0-9]*$", ""), r"[.]+$", "")


def judge(
    pages: DataFrame,
    url: str = "url",
    rules: Iterable[tuple[str, str]] = RULES,
    block_words: Iterable[str] = BLOCK_WORDS,
    block_globs: Iterable[str] = (),
) -> DataFrame:
    """All columns of ``pages`` and host, path, rule, verdict, pattern (the block glob that fitted, or null).

    The longest fitting rule decides (the first of equals); without one, the
    URL is blocked if a glob fits (``block_globs``, then those of ``block_words``; the first that fits is told)
    and allowed otherwise.  Rules see host and path as they stand, globs the canonical host, and the path or ``/``.
    A null URL, or one without ``://``, has an empty host and path and is allowed.  Whole URLs count, however
    long.  Columns of ``pages`` that bear a result's name are replaced.  One row comes out for each row, repeated
    ones too; an empty table gives none.
    """
    rules, block_globs = list(rules), [*block_globs, *(g for w in block_words for g in word_globs(w))]
    prepare(pages.sparkSession)
    ranked = sorted(rules, key=lambda r: -len(r[1]))
    by_rules, by_globs = Automaton.build([g for _, r in ranked for g in rule_globs(r)]), Automaton.build(block_globs)

    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for host, path, plain in parts:
            by_rule = by_rules.match([h.encode("utf-8", "replace") + p.encode("utf-8", "replace") for h, p in zip(host, path, strict=True)])
            by_rule = by_rule.reshape(len(host), len(ranked), 2).any(axis=2)
            by_glob = by_globs.match([(c + (p or "/")).encode("utf-8", "replace") if c else b"" for c, p in zip(plain, path, strict=True)])
            r = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1), -1) if ranked else np.full(len(host), -1)
            g = np.where(by_glob.any(axis=1), by_glob.argmax(axis=1), -1) if block_globs else np.full(len(host), -1)
            yield pd.DataFrame(
                {
                    "rule": [ranked[i][1] if i >= 0 else None for i in r],
                    "verdict": [ranked[i][0] if i >= 0 else "block" if j >= 0 else "allow" for i, j in zip(r, g, strict=True)],
                    "pattern": [block_globs[j] if i < 0 and j >= 0 else None for i, j in zip(r, g, strict=True)],
                }
            )

    match = F.pandas_udf(run, "rule string, verdict string, pattern string")
    src = F.col(f"`{url}`")
    mine = {"host", "path", "rule", "verdict", "pattern", "_m"}
    keep = [f"`{c}`" for c in pages.columns if c.lower() not in mine]
    # what is asked of the URL is made in one projection, so that a url column named like a result still works
    made = pages.select(*keep, host_of(src).alias("host"), path_of(src).alias("path"))
    return made.withColumn("_m", match("host", "path", canonical(F.col("host")))).select(*keep, "host", "path", "_m.rule", "_m.verdict", "_m.pattern")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "pattern")


_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{r}'"
    for r, h, p in sorted(((r, *r.split("/", 1)) for _, r in RULES), key=lambda x: -len(x[0]))
)
_SAYS = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in RULES)
_GLOBS = " ".join(
    f"WHEN regexp_matches(plain, '^{b}{w}{e}') THEN '{g}'"
    for w in BLOCK_WORDS
    for g, (b, e) in zip(word_globs(w), [(b, e) for b in ("", "[^/]*[.]", "[^/]*-") for e in ("$", "[.]", "-")], strict=True)
)
_PLAIN = "regexp_replace(host, '^.*@', '')"
for _c in (*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x2D, 0x2E):
    _PLAIN = f"replace({_PLAIN}, '%{_c:02x}', '{chr(_c).lower()}')"

ORACLE_SQL = f"""
WITH a AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
b AS (
  SELECT *, CASE {_FITS} END AS rule, regexp_replace(regexp_replace({_PLAIN}, ':[0-9]*$', ''), '[.]+$', '') AS plain FROM a),
c AS (SELECT *, CASE WHEN rule IS NOT NULL THEN NULL {_GLOBS} END AS pattern FROM b)
SELECT page_id, host, path, rule,
  CASE {_SAYS} WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern
FROM c
"""
