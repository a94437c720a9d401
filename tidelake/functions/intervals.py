"""Interval names and window arithmetic in epoch milliseconds."""

from __future__ import annotations

import re

STEP_MS = 300_000
INTERVALS = ("5m", "15m", "1h", "4h", "1d")
_UNIT = {"m": 60_000, "h": 3_600_000, "d": 86_400_000}
DAY_MS = _UNIT["d"]


def to_ms(interval: str, lenient: bool = False) -> int:
    """Milliseconds of an interval such as 15m, 4H or 1d.  Unknown text is an error, or a minute if lenient."""
    m = re.fullmatch(r"(\d+)([mhd])", interval.strip().lower())
    if m and int(m[1]):
        return int(m[1]) * _UNIT[m[2]]
    if lenient:
        return 60_000
    raise ValueError(f"not an interval: {interval!r}")
