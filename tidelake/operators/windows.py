"""Sliding windows [end - size, end) at a fixed step, labelled by their end.

Two ways: rows are copied to each window they lie in (any aggregate), or
aggregated once into step-long panes that windows then combine (algebraic
aggregates; the work no longer grows with size / step).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.intervals import DAY_MS, STEP_MS


def pane_of(t: Column, step: int = STEP_MS) -> Column:
    """End of the pane that holds the time."""
    return (F.floor(t / F.lit(step)) + 1).cast("long") * step


def spread(df: DataFrame, time: str, size: int, step: int = STEP_MS) -> DataFrame:
    """A row for each window a row lies in, with ``window_end``."""
    first = pane_of(F.col(time), step)
    if size == step:
        return df.withColumn("window_end", first)
    return df.withColumn("window_end", F.explode(F.sequence(first, first + F.lit(size - step), F.lit(step))))


def source_days(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Days on which rows exist: only their windows are made."""
    return df.select(*keys, F.floor(F.col(time) / F.lit(DAY_MS)).alias("_day")).distinct()


def on_source_days(windows: DataFrame, days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A window belongs to the day that its last millisecond lies in."""
    marked = windows.withColumn("_day", F.floor((F.col("window_end") - 1) / F.lit(DAY_MS)))
    return marked.join(days, [*keys, "_day"], "left_semi").drop("_day")


def in_own_day(size: int, step: int) -> bool:
    """Windows of one step that days are made of: each lies in the day of its rows, so all of them are made."""
    return size == step and DAY_MS % step == 0


def window_grid(days: DataFrame, keys: Sequence[str] = (), step: int = STEP_MS) -> DataFrame:
    """All window ends of the given days."""
    start = F.col("_day") * DAY_MS
    return days.select(*keys, F.explode(F.sequence(start + F.lit(step), start + F.lit(DAY_MS), F.lit(step))).alias("window_end"))


def over_panes(size: int, keys: Sequence[str] = (), step: int = STEP_MS):
    """Frame of the panes of the window that ends with the row's pane; by time, so missing panes don't shift it."""
    return Window.partitionBy(*keys).orderBy("window_end").rangeBetween(-(size - step), 0)


#: Pieces of time in which raw rows are ordered; between pieces only one row a piece is carried.
CHUNK_MS = 3_600_000


def with_previous(df: DataFrame, time: str, order: Sequence[str], values: dict[str, Column], keys: Sequence[str] = (), chunk: int = CHUNK_MS) -> DataFrame:
    """Adds under each name the latest value that isn't null of the rows before by ``order`` (which begins with the time).

    No task orders the whole series: rows are ordered within pieces of time, and what a piece ends
    with is carried to the next ones over a table of one row a piece.  Rows are dealt out by piece before
    the values are worked out, so the shuffle holds the given columns only.
    """
    piece = F.floor(F.col(time) / F.lit(chunk))
    within = Window.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    dealt = df.withColumn("_piece", piece).repartition(*keys, "_piece")
    rows = dealt.withColumns({n: F.last(v, ignorenulls=True).over(within) for n, v in values.items()})
    last = [F.max_by(v, F.when(v.isNotNull(), F.struct(*order))).alias(f"_of{k}") for k, v in enumerate(values.values())]
    ends = df.groupBy(*keys, piece.alias("_piece")).agg(*last)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_piece", *[F.last(f"_of{k}", ignorenulls=True).over(before).alias(f"_on{k}") for k in range(len(values))])
    got = rows.join(carried, [*keys, "_piece"], "left")
    return got.withColumns({n: F.coalesce(F.col(n), F.col(f"_on{k}")) for k, n in enumerate(values)}).drop("_piece", *[f"_on{k}" for k in range(len(values))])


def places(df: DataFrame, time: str, name: str, keys: Sequence[str] = (), chunk: int = CHUNK_MS) -> DataFrame:
    """Adds each row's place by time, from 0, for each key: ranks within pieces of time and counts of the pieces before."""
    piece = F.floor(F.col(time) / F.lit(chunk))
    ranked = df.withColumn("_piece", piece).withColumn(name, F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(time)) - 1)
    counts = df.groupBy(*keys, piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return ranked.join(counts, [*keys, "_piece"]).withColumn(name, F.col(name) + F.col("_before")).drop("_piece", "_before")


def end_time(end: Column) -> Column:
    """The label as a timestamp without zone, in UTC whatever the session's zone is."""
    return F.timestamp_add("MILLISECOND", end, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
