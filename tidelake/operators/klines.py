"""Candles: built from ticks, and rebuilt for sliding windows by their close time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.intervals import STEP_MS, to_ms

from . import panes as P
from . import windows as W

MINUTE = 60_000
NAMES = ("open", "high", "low", "close", "mean", "std")


def from_ticks(ticks: DataFrame, time: str, price: str, tie: str, keys: Sequence[str] = (), size: int = MINUTE) -> DataFrame:
    """open_time and open, high, low, close of each period that has ticks."""
    order = F.struct(time, tie)
    return (
        ticks.withColumn("open_time", (F.floor(F.col(time) / F.lit(size)) * size).cast("long"))
        .groupBy(*keys, "open_time")
        .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"))
    )


def metrics() -> list[Column]:
    """Window aggregates of candles; rows carry ``window_end`` and ``close_time``."""
    close, at = F.col("close"), F.col("close_time")
    made = (F.min_by("open", at), F.max("high"), F.min("low"), F.max_by(close, at), F.avg(close), F.stddev_samp(close))
    return [x.alias(n) for n, x in zip(NAMES, made, strict=True)]


def recipe(size: int, step: int, only: Sequence[str] = ()) -> P.Recipe:
    """What metrics() says, for windows out of panes; a day has candles where one opens."""
    r, c = P.Recipe("close_time", size, step, only, source="open_time"), F.col
    r.edge("open", c("open"), c("close_time"), False)
    r.high("high", c("high"))
    r.low("low", c("low"))
    r.edge("close", c("close"), c("close_time"), True)
    r.spread("close", c("close"), "mean", "std")
    return r


def aggregate(klines: DataFrame, interval: str, keys: Sequence[str] = (), step: int = STEP_MS, candle: int = MINUTE, only: Sequence[str] = ()) -> DataFrame:
    """Keys, window_end, open, high, low, close, mean and std of closes, or ``only`` some of them.

    A candle counts at its close, so one that closes exactly at a window's end
    belongs to the next window.  Windows without an open price have no row.
    Windows come from panes, so neither candles nor their copies are dealt out by day.
    """
    size = to_ms(interval)
    rows, names = klines.withColumn("close_time", F.col("open_time") + F.lit(candle)), list(only) or list(NAMES)
    if P.suits(size, step) or W.in_own_day(size, step):
        got = P.combine(rows, recipe(size, step, [*names, "open"]), keys)
    else:
        spread = W.on_source_days(W.spread(rows, "close_time", size, step), W.source_days(klines, "open_time", keys), keys)
        got = spread.groupBy(*keys, "window_end").agg(*metrics())
    return got.where(F.col("open").isNotNull()).select(*keys, "window_end", *names)
