"""Bronze repair: rows put under their own date, duplicates out, gaps found, partitions upserted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.intervals import DAY_MS

#: Gaps between rows that count as missing data, in ms.
GAP_MS = {"trades": 60_000, "fundingRate": 12 * 3_600_000}


def kline_gap(interval_ms: int) -> int:
    return interval_ms * 3 // 2


def event_date(t: Column) -> Column:
    """UTC date of epoch milliseconds, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(t / F.lit(DAY_MS)).cast("int"))


def event_month(t: Column) -> Column:
    return F.trunc(event_date(t), "month")


def misplaced(df: DataFrame, time: str, file_date: str, grain: str = "day") -> DataFrame:
    """Rows whose time lies outside the UTC day or month that their file names, with ``target_date``."""
    own = event_date(F.col(time)) if grain == "day" else event_month(F.col(time))
    named = F.col(file_date) if grain == "day" else F.trunc(F.col(file_date), "month")
    return df.withColumn("target_date", own).where(F.col("target_date") != named)


def dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row of each key: the first or last by ``order``."""
    if keep not in ("first", "last"):
        raise ValueError("keep is first or last")
    by = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*by))).where("_n = 1").drop("_n")


def duplicate_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """duplicate_keys, duplicate_rows (rows beyond the first of each key)."""
    per = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return per.agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def gaps_within(df: DataFrame, time: str, threshold: int, keys: Sequence[str] = ()) -> DataFrame:
    """gap_start, gap_end (both missing) and gap_ms between rows of one UTC day; days are searched in parallel."""
    day = df.select(*keys, F.col(time).alias("_t")).withColumn("_day", F.floor(F.col("_t") / F.lit(DAY_MS)))
    nxt = day.withColumn("_next", F.lead("_t").over(Window.partitionBy(*keys, "_day").orderBy("_t")))
    gap = F.col("_next") - F.col("_t")
    return nxt.where(gap > threshold).select(*keys, (F.col("_t") + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end"), gap.alias("gap_ms"))


def gaps_between(df: DataFrame, time: str, threshold: int, keys: Sequence[str] = ()) -> DataFrame:
    """Gaps from a day's last row to the next day-with-rows' first."""
    per = df.groupBy(*keys, F.floor(F.col(time) / F.lit(DAY_MS)).alias("_day")).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    nxt = per.withColumn("_next", F.lead("_lo").over(Window.partitionBy(*keys).orderBy("_day")))
    gap = F.col("_next") - F.col("_hi")
    return nxt.where(gap > threshold).select(*keys, (F.col("_hi") + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end"), gap.alias("gap_ms"))


def gap_before(df: DataFrame, time: str, base: int, keys: Sequence[str] = ()) -> DataFrame:
    """The stretch from a base time to the first row, if there is one."""
    first = df.groupBy(*keys).agg(F.min(time).alias("_lo")) if keys else df.agg(F.min(time).alias("_lo"))
    return first.where(F.col("_lo") > base).select(*keys, F.lit(base).cast("long").alias("gap_start"), (F.col("_lo") - 1).alias("gap_end"), (F.col("_lo") - F.lit(base)).alias("gap_ms"))


def gaps(df: DataFrame, time: str, threshold: int, keys: Sequence[str] = (), base: int | None = None) -> DataFrame:
    """All gaps with their ``kind``: internal, boundary and, given a base time, prehistory."""
    out = gaps_within(df, time, threshold, keys).withColumn("kind", F.lit("internal")).unionByName(gaps_between(df, time, threshold, keys).withColumn("kind", F.lit("boundary")))
    return out if base is None else out.unionByName(gap_before(df, time, base, keys).withColumn("kind", F.lit("prehistory")))


def missing_days(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Days from start to end (inclusive) without a row."""
    want = df.sparkSession.sql(f"SELECT explode(sequence(date'{start}', date'{end}')) AS missing_date")
    return want.join(df.select(event_date(F.col(time)).alias("missing_date")).distinct(), "missing_date", "left_anti")


def merge_rows(old: DataFrame | None, new: DataFrame, key: Sequence[str], keep: str = "last") -> DataFrame:
    """Old and new rows with one for each key: the new one (last) or the old one (first)."""
    tagged = new.withColumn("_age", F.lit(1))
    both = tagged if old is None else old.withColumn("_age", F.lit(0)).unionByName(tagged, allowMissingColumns=True)
    return dedupe(both, key, ["_age"], keep).drop("_age")
