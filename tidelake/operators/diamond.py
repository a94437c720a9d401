"""Diamond: training sets of each interval out of the gold frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import INTERVALS, STEP_MS, to_ms

from . import windows as W

TIME = "window_end"
#: Parts of column names that every training set keeps, and those of features over two intervals.  Fixed values.
ALWAYS = ("timestamp_dt", "funding_", "feat_hour_sin", "feat_hour_cos")
CROSS = ("_alignment_", "_divergence_", "_expansion_")


def complete(df: DataFrame) -> DataFrame:
    """Rows without a null in any column; NaN is a value here, which na.drop would not allow."""
    return df.where(reduce(lambda a, b: a & b, [S.col(c).isNotNull() for c in df.columns]))


def nan_for_null(df: DataFrame, columns: Sequence[str], where: str) -> DataFrame:
    """NaN in place of nulls of the given statistics where the count column says that there were rows."""
    return df.withColumns({c: F.when(S.col(c).isNull() & (S.col(where) > 0), F.lit(float("nan"))).otherwise(S.col(c)) for c in columns})


def columns_for(columns: Sequence[str], interval: str, time: str = TIME) -> list[str]:
    """Columns of an interval's training set, sorted.

    A name is kept for its time, funding and hour parts, as the interval's label, for holding
    ``_j_`` of an interval j no shorter, or as a feature over several intervals of which this is
    the shortest.
    """
    longer = INTERVALS[INTERVALS.index(interval) :]

    def cross(c: str) -> bool:
        if "feat_" not in c or not any(p in c for p in CROSS):
            return False
        found = [p for p in c.split("_") if p in INTERVALS]
        return len(found) >= 2 and min(found, key=INTERVALS.index) == interval

    keep = {c for c in columns if c == time or c == f"label_{interval}" or any(p in c for p in ALWAYS) or any(f"_{j}_" in c for j in longer) or cross(c)}
    return sorted(keep)


def downsample(df: DataFrame, interval: str, keys: Sequence[str] = (), time: str = TIME, align: str = "position") -> DataFrame:
    """Every Nth row, N rows being the interval: by place after filtering, or by the clock."""
    n = to_ms(interval) // STEP_MS
    if align == "clock":
        return df.where(F.pmod(F.col(time), F.lit(to_ms(interval))) == 0)
    if align != "position":
        raise ValueError("align is position or clock")
    return W.places(df, time, "_place", keys).where(F.col("_place") % n == 0).drop("_place")


def dataset(gold: DataFrame, interval: str, keys: Sequence[str] = (), time: str = TIME, align: str = "position") -> DataFrame:
    """Complete rows, this interval's columns, downsampled."""
    picked = sorted({*columns_for(gold.columns, interval, time), *keys})
    return downsample(complete(gold).select(*[S.col(c) for c in picked]), interval, keys, time, align)


def write_datasets(gold: DataFrame, root: str, intervals: Sequence[str] = INTERVALS, keys: Sequence[str] = (), time: str = TIME, align: str = "position") -> dict[str, str]:
    """One Parquet folder for each interval's training set; the folders by interval."""
    out = {}
    for i in intervals:
        out[i] = f"{root}/diamond/{i}"
        dataset(gold, i, keys, time, align).write.mode("overwrite").parquet(out[i])
    return out
