"""Feeds made out of the ``events`` table, so that every stage runs on the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import STEP_MS
from tidelake.operators import book, gold, klines, trades
from tidelake.operators import windows as W


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df.withColumn("ms", F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")))


def trade_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("event_type").isin("click", "purchase"), "buy").when(F.col("event_type").isin("view", "signup"), "sell").otherwise("other")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("trade_id"),
        side.alias("side"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"),
        F.col("ms").alias("created_time"),
    )


def book_feed(spark: SparkSession, sf_dir: str, before: bool = False) -> DataFrame:
    """Sixty levels a side, as JSON text; with the time of the snapshot before, if asked, found while rows are slim."""

    def side(price, qty) -> F.Column:
        return F.to_json(F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.array(price(i).cast("string"), qty(i).cast("string"))))

    v, e = F.col("value"), F.col("event_id")
    bids = side(lambda i: F.lit(1000.0) + v - F.lit(0.1) * (i + 1), lambda i: F.lit(1) + (e * 7 + i * 3) % 11)
    asks = side(lambda i: F.lit(1000.0) + v + F.lit(0.1) * (i + 1) + F.lit(0.05) * (e % 7), lambda i: F.lit(1) + (e * 5 + i * 2) % 13)
    action = F.when(F.col("event_type") == "error", "update").otherwise("snapshot")
    # the table is one small file; sixty levels a row are made and parsed by all cores, the rows of a pane by one, so that
    # what is aggregated is a row a pane, not one for each pane and task; that is a small shuffle, which all intervals share
    rows = events(spark, sf_dir).select("event_id", "event_type", "value", "ms")
    if before:
        spread = W.with_previous(rows, "ms", ["ms", "event_id"], {"_prev_t": F.when(action == "snapshot", F.col("ms"))})
    else:
        spread = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.floor(F.col("ms") / F.lit(STEP_MS)))
    return spread.select(F.col("ms").alias("ts"), F.col("event_id").alias("seq"), action.alias("action"), asks.alias("asks"), bids.alias("bids"), *(["_prev_t"] if before else []))


def book_rows(spark: SparkSession, sf_dir: str, before: bool = False) -> DataFrame:
    """Features of the snapshots, rounded, so that equal values are equal whatever the order of summation."""
    f = book.features(book_feed(spark, sf_dir, before))
    plain = ["ts", "seq", *(["_prev_t"] if before else [])]
    return f.select(*plain, *[F.round(S.col(c), 9).alias(c) for c in f.columns if c not in plain])


def kline_feed(spark: SparkSession, sf_dir: str, kind: str = "index") -> DataFrame:
    rows = events(spark, sf_dir)
    rows = rows if kind == "index" else rows.where(F.col("event_type") != "error")
    return klines.from_ticks(rows, "ms", "value", "event_id")


def funding_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = (F.floor(F.col("ms") / 28_800_000) * 28_800_000).cast("long")
    return events(spark, sf_dir).groupBy(at.alias("funding_time")).agg((F.avg("value") / 10000).alias("funding_rate"))


def gold_base(spark: SparkSession, sf_dir: str, intervals: Sequence[str] = ("5m", "15m"), depth: bool = False, fill: bool = True) -> DataFrame:
    """Book, trade, index and mark windows and funding, merged on time, funding carried forward."""
    feed, rows = trade_feed(spark, sf_dir), book_rows(spark, sf_dir)
    index, mark = kline_feed(spark, sf_dir), kline_feed(spark, sf_dir, "mark")
    sources: dict[str, DataFrame] = {}
    for i in intervals:
        names = ("sum_bid_5", "sum_bid_20", "sum_bid_50", "sum_ask_20", "sum_ask_50", "best_bid", "best_ask", "bid_px_20", "ask_px_20", "total_depth_50") if depth else ()
        ob = book.aggregate(rows, i, only=("wmp_last", "wmp_min", "wmp_max", "wmp_mean", "spread_mean"), lasts=names)
        sources[f"orderbook_{i}_"] = ob
        flow = ("price_mean_trade", "price_std_trade", "price_min_trade", "price_max_trade", "price_last_trade", "volume_buy", "volume_sell", "turnover_buy", "turnover_sell", "count_buy", "count_sell")
        sources[f"trades_{i}_"] = trades.aggregate(feed, i, ["flow", "core"], only=flow)
        sources[f"index_price_{i}_"] = klines.aggregate(index, i, only=("close", "mean", "std"))
        sources[f"mark_price_{i}_"] = klines.aggregate(mark, i, only=("mean",))
    sources["funding_"] = funding_feed(spark, sf_dir).withColumn("window_end", F.col("funding_time"))
    wide = gold.merge(sources)
    return gold.forward_fill(wide, ["funding_funding_rate", "funding_funding_time"]) if fill else wide
