"""Vectorised hashes of words and parts of words over many texts at once.

A prefix sum of byte values times powers of an odd base (modulo 2**64) gives
the polynomial hash of every byte range in two look-ups; multiplying by the
inverse power makes it independent of where the range lies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
#: Bytes hashed at once; bounds the working memory of a task.
STEP_BYTES = 1 << 20

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _to(n: int) -> None:
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(n + 1, STEP_BYTES + 1)
        inv = pow(_BASE, -1, 1 << 64)
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _BASE, np.uint64))])
        _inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, inv, np.uint64))])


def mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit of the hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Ranges:
    """Hashes of ranges of one buffer of bytes or of 64-bit values."""

    def __init__(self, raw: np.ndarray):
        _to(len(raw))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_TABLE[raw] if raw.dtype == np.uint8 else raw) * _powers[: len(raw)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * _inverse[start]
        return mixed(h + (end - start).astype(np.uint64))


def runs(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def steps(raws: Iterable[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) in steps of about STEP_BYTES; a longer text is a step of its own."""
    at, held, size = 0, [], 0
    for i, r in enumerate(raws):
        if held and size + len(r) > STEP_BYTES:
            yield at, held
            at, held, size = i, [], 0
        held.append(r)
        size += len(r) + 1
    if held:
        yield at, held


def join(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a line feed after each text, and where each text begins."""
    raw = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
    n = np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws))
    return raw, np.cumsum(n) - n
