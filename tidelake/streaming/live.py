"""Live feeds: subscription, raw messages to bronze rows, duplicates dropped by watermark, windows, upserts."""

from __future__ import annotations

import importlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from tidelake.functions.intervals import to_ms
from tidelake.sources import lake
from tidelake.sources.rest import ATTEMPTS, BACKOFF, BACKOFF_MOST

FLUSH = "8 seconds"
_ARG = "arg struct<channel: string, instId: string>"
_RECORDS = {
    "trades": "tradeId string, side string, px string, sz string, ts string",
    "orderBook": "instId string, action string, ts string, asks array<array<string>>, bids array<array<string>>",
    "fundingRate": "fundingRate string, fundingTime string",
}


#: Channels of each feed; candles have one an interval.  Fixed values.
CANDLES = ("1m", "5m", "15m", "1H", "4H", "1D")
CHANNELS = {
    "trades": ("trades",),
    "orderBook": ("books",),
    "fundingRate": ("funding-rate",),
    "markPriceKlines": tuple(f"mark-price-candle{i}" for i in CANDLES),
    "indexPriceKlines": tuple(f"index-candle{i}" for i in CANDLES),
}


def subscription(feed: str, symbol: str) -> str:
    """The message that subscribes to a feed's channels."""
    return json.dumps({"op": "subscribe", "args": [{"channel": c, "instId": symbol} for c in CHANNELS[feed]]})


class LiveReader(SimpleDataSourceStreamReader):
    """Messages of an injected transport: a callable ``(subscription, offset) -> (messages, next offset)``, named by module
    and attribute, that connects if it has to and can give what it gave from an offset once more.

    A lost connection (OSError) is tried again, after 1 second and up to 60.
    """

    def __init__(self, options: dict):
        self.message = subscription(options["feed"], options.get("symbol", ""))
        self.module, _, self.attribute = options["transport"].rpartition(".")

    def _receive(self, offset: int) -> tuple[list[str], int]:
        receive, wait = getattr(importlib.import_module(self.module), self.attribute), BACKOFF
        for attempt in range(ATTEMPTS):
            try:
                return receive(self.message, offset)
            except OSError:
                if attempt == ATTEMPTS - 1:
                    raise
                time.sleep(wait)
                wait = min(wait * 2, BACKOFF_MOST)
        raise AssertionError

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict):
        messages, after = self._receive(start["at"])
        return iter([(m,) for m in messages]), {"at": after}

    def readBetweenOffsets(self, start: dict, end: dict):
        at = start["at"]
        while at < end["at"]:
            messages, after = self._receive(at)
            if after <= at:
                return
            yield from ((m,) for m in messages[: end["at"] - at])
            at = after


class Live(DataSource):
    @classmethod
    def name(cls) -> str:
        return "exchange_live"

    def schema(self) -> str:
        return "value string"

    def simpleStreamReader(self, schema) -> LiveReader:
        return LiveReader(dict(self.options))


def subscribe(spark: SparkSession, feed: str, transport: str, symbol: str = "") -> DataFrame:
    """A stream of a feed's raw messages (``value``), for parse()."""
    spark.dataSource.register(Live)
    return spark.readStream.format("exchange_live").options(feed=feed, transport=transport, symbol=symbol).load()


def parse(messages: DataFrame, feed: str, value: str = "value") -> DataFrame:
    """Bronze rows of JSON messages ``{"arg": ..., "data": [...]}``; what doesn't parse is dropped."""
    kind = f"array<struct<{_RECORDS[feed].replace(' ', ': ').replace(',:', ',')}>>" if feed in _RECORDS else "array<array<string>>"
    m = messages.select(F.from_json(F.col(value).cast("string"), f"{_ARG}, data {kind}").alias("m")).select(F.col("m.arg.instId").alias("_symbol"), F.explode("m.data").alias("r"))
    r = lambda n, t: F.col(f"r.{n}").try_cast(t)
    if feed == "trades":
        rows = m.select(F.col("_symbol").alias("instrument_name"), r("tradeId", "bigint").alias("trade_id"), F.col("r.side").alias("side"), r("px", "double").alias("price"), r("sz", "double").alias("size"), r("ts", "bigint").alias("created_time"))
    elif feed == "orderBook":
        rows = m.select(F.coalesce("r.instId", "_symbol").alias("instId"), F.col("r.action").alias("action"), r("ts", "bigint").alias("ts"), F.to_json("r.asks").alias("asks"), F.to_json("r.bids").alias("bids"))
    elif feed == "fundingRate":
        rows = m.select(F.col("_symbol").alias("instrument_name"), r("fundingRate", "double").alias("funding_rate"), r("fundingTime", "bigint").alias("funding_time"))
    else:
        at = lambda i, t: F.get("r", F.lit(i)).try_cast(t)
        rows = m.select(at(0, "bigint").alias("open_time"), *[at(i, "double").alias(n) for i, n in enumerate(("open", "high", "low", "close"), 1)], F.col("_symbol").alias("symbol"))
    return rows.where(F.col(lake.TIMES[feed]).isNotNull())


def once(rows: DataFrame, feed: str, late: str = "10 minutes") -> DataFrame:
    """Rows with ``event_time``, each key once within the watermark; state is dropped behind it."""
    keyed = rows.withColumn("event_time", F.timestamp_millis(F.col(lake.TIMES[feed]))).withWatermark("event_time", late)
    return keyed.dropDuplicatesWithinWatermark(lake.KEYS[feed])


def windows(trades: DataFrame, interval: str, step: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Sliding-window flow of a trade stream (append mode): window_end, count, volumes by side, price range and mean."""
    timed = trades if "event_time" in trades.columns else trades.withColumn("event_time", F.timestamp_millis("created_time")).withWatermark("event_time", late)
    size = f"{to_ms(interval) // 1000} seconds"
    side = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("size"))), F.lit(0.0))
    agg = timed.groupBy(F.window("event_time", size, step)).agg(F.count(F.lit(1)).alias("trade_count"), side("buy").alias("volume_buy"), side("sell").alias("volume_sell"), F.min("price").alias("price_min_trade"), F.max("price").alias("price_max_trade"), F.avg("price").alias("price_mean_trade"))
    return agg.select(F.unix_millis(F.col("window.end")).alias("window_end"), *[c for c in agg.columns if c != "window"])


def to_bronze(
    rows: DataFrame,
    root: str,
    feed: str,
    checkpoint: str,
    symbol: str | None = None,
    interval: str | None = None,
    available_now: bool = False,
    late_ms: int | None = None,
) -> StreamingQuery:
    """Each micro-batch is merged by key into the dates its rows belong to; a replayed batch changes nothing.

    The last message of a key wins, so a candle ends with its final values.  With ``late_ms``, rows that much
    older than the newest of their batch go to the layer ``late`` instead, from which merge_late() takes them.
    """

    def merge(batch: DataFrame, _: int) -> None:
        out = batch
        if symbol is not None:
            out = out.withColumn("symbol", F.lit(symbol))
        if interval is not None:
            out = out.withColumn("interval", F.lit(interval))
        if late_ms is None:
            lake.upsert(out, root, feed)
            return
        out = out.persist()
        newest = out.agg(F.max(lake.TIMES[feed])).first()[0]
        if newest is not None:
            old = F.col(lake.TIMES[feed]) < newest - late_ms
            lake.upsert(out.where(~old), root, feed)
            if not out.where(old).isEmpty():
                lake.upsert(out.where(old), root, feed, "late")
        out.unpersist()

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=FLUSH)).start()


def merge_late(spark: SparkSession, root: str, feed: str) -> int:
    """Merges what came late into bronze, where rows that are there already stay; how many there were."""
    late = lake.read(spark, root, feed, "late")
    lake.upsert(late.drop("dt"), root, feed, keep="first")
    return late.count()


def finish(query: StreamingQuery) -> None:
    """Takes in what has arrived, then stops: for a process that is told to end."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def inter_arrival(trades: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Five-minute windows of a trade stream (append mode): window_end, trade_count and mean, least, largest and deviation
    of the times between trades that follow one another in the window, in ms.

    A stream has no lag; a window's times are gathered and sorted when the watermark closes it.
    """
    timed = trades if "event_time" in trades.columns else trades.withColumn("event_time", F.timestamp_millis("created_time")).withWatermark("event_time", late)
    held = timed.groupBy(F.window("event_time", "5 minutes")).agg(F.sort_array(F.collect_list("created_time")).alias("t"))
    gaps = F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: (F.get("t", i) - F.get("t", i - 1)).cast("double"))
    got = held.select(F.unix_millis(F.col("window.end")).alias("window_end"), F.size("t").cast("long").alias("trade_count"), F.when(F.size("t") > 1, gaps).alias("g"))
    mean = F.aggregate("g", F.lit(0.0), lambda a, x: a + x) / F.size("g")
    got = got.withColumn("rate_mean_ms_trade", F.when(F.col("g").isNotNull(), mean))
    square = F.aggregate(F.transform("g", lambda x: (x - F.col("rate_mean_ms_trade")) * (x - F.col("rate_mean_ms_trade"))), F.lit(0.0), lambda a, x: a + x)
    return got.select(
        "window_end",
        "trade_count",
        "rate_mean_ms_trade",
        F.when(F.size("g") > 1, F.sqrt(square / F.greatest(F.size("g") - 1, F.lit(1)))).alias("rate_std_ms_trade"),
        F.array_max("g").alias("rate_max_ms_trade"),
        F.array_min("g").alias("rate_min_ms_trade"),
    )
