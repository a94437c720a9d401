"""Paged history of an exchange as a batch data source: one partition for each gap, newest page first; and what to fetch.

The transport is injected: a callable ``(feed, symbol, interval, after_ms) -> list of records``
named by module and attribute, so tests use recorded pages and clusters an HTTP client.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.utils import AnalysisException

from . import lake
from .lake import SCHEMAS

PAGE = 100
#: Wait between failed attempts, doubled up to the last, in seconds.
BACKOFF, BACKOFF_MOST, ATTEMPTS = 1.0, 60.0, 6


class Gap(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def normalise(feed: str, symbol: str, r) -> tuple | None:
    """A record of the feed's pages or messages as a bronze row; None if it doesn't parse."""
    try:
        if feed == "trades":
            return symbol, int(r["tradeId"]), r["side"], float(r["px"]), float(r["sz"]), int(r["ts"])
        if feed == "fundingRate":
            return symbol, float(r["fundingRate"]), int(r["fundingTime"])
        if feed == "orderBook":
            return r.get("instId", symbol), r["action"], int(r["ts"]), json.dumps(r["asks"]), json.dumps(r["bids"])
        return int(r[0]), float(r[1]), float(r[2]), float(r[3]), float(r[4])
    except (KeyError, ValueError, TypeError, IndexError):
        return None


def raw_time(feed: str, r) -> int | None:
    """The time of a record, also of one that doesn't parse otherwise; None if it has none."""
    try:
        return int(r[{"trades": "ts", "fundingRate": "fundingTime", "orderBook": "ts"}[feed]] if feed in ("trades", "fundingRate", "orderBook") else r[0])
    except (KeyError, ValueError, TypeError, IndexError):
        return None


def time_of(feed: str, row: tuple) -> int:
    return row[{"trades": 5, "fundingRate": 2, "orderBook": 2}.get(feed, 0)]


class HistoryReader(DataSourceReader):
    def __init__(self, options: dict):
        self.feed, self.symbol, self.interval = options["feed"], options.get("symbol", ""), options.get("interval", "")
        module, _, name = options["transport"].rpartition(".")
        self.module, self.name = module, name
        self.gaps = json.loads(options["gaps"])

    def partitions(self):
        return [Gap(int(a), int(b)) for a, b in self.gaps]

    def read(self, partition) -> Iterator[tuple]:
        fetch = getattr(importlib.import_module(self.module), self.name)
        cursor, wait, failed = partition.end + 1, BACKOFF, 0
        seen: set[tuple] = set()  # rows of the millisecond that a page ended with
        while cursor > partition.start:
            try:
                page = fetch(self.feed, self.symbol, self.interval, cursor)
            except OSError:
                failed += 1
                if failed >= ATTEMPTS:
                    raise
                time.sleep(wait)
                wait = min(wait * 2, BACKOFF_MOST)
                continue
            wait, failed = BACKOFF, 0
            rows = [x for x in (normalise(self.feed, self.symbol, r) for r in page) if x is not None and x not in seen]
            yield from (x for x in dict.fromkeys(rows) if partition.start <= time_of(self.feed, x) <= partition.end)
            if len(page) < PAGE:
                return
            times = [t for t in (raw_time(self.feed, r) for r in page) if t is not None]
            if not times:
                raise ValueError("a full page without a time that can be read: the gap can't be followed")
            oldest = min(times)
            # the millisecond that the page ended in is asked for again, since it may go on
            if oldest + 1 >= cursor:
                raise ValueError(f"more rows in millisecond {oldest} than a page holds: the gap can't be filled by time")
            seen = {x for x in [*rows, *seen] if time_of(self.feed, x) == oldest}
            cursor = oldest + 1


class History(DataSource):
    @classmethod
    def name(cls) -> str:
        return "exchange_history"

    def schema(self) -> str:
        return SCHEMAS[self.options["feed"]]

    def reader(self, schema) -> HistoryReader:
        return HistoryReader(dict(self.options))


def backfill(spark: SparkSession, feed: str, gaps: list[tuple[int, int]], transport: str, symbol: str = "", interval: str = "") -> DataFrame:
    """Rows of the feed within the gaps (start and end in ms, both included)."""
    spark.dataSource.register(History)
    return spark.read.format("exchange_history").options(feed=feed, gaps=json.dumps(gaps), transport=transport, symbol=symbol, interval=interval).load()


#: Bytes under which a day of books counts as incomplete, and seconds between rounds and after a failed one.  Fixed values.
BOOK_LEAST, POLL, POLL_FAILED = 200 * 1024 * 1024, 8 * 3600, 3600


def wanted(spark: SparkSession, root: str, feed: str, start: str, end: str) -> DataFrame:
    """Dates from start to end (inclusive) to fetch: those not on file, and days of books that are too small to be whole."""
    days = spark.sql("SELECT explode(sequence(to_date(:a), to_date(:b))) AS dt", {"a": start, "b": end})
    try:
        have = lake.present_dates(spark, root, feed)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return days
    least = BOOK_LEAST if feed == "orderBook" else 0
    return days.join(have.where(F.col("bytes") >= least).select("dt"), "dt", "left_anti")


def available(spark: SparkSession, dates: DataFrame, probe: str) -> DataFrame:
    """The dates for which the probe, a callable ``(date text) -> bool`` named by module and attribute, says yes; OSError is no."""
    module, _, name = probe.rpartition(".")

    def ask(frames):
        there = getattr(importlib.import_module(module), name)
        for frame in frames:
            keep = []
            for d in frame["dt"]:
                try:
                    keep.append(bool(there(str(d))))
                except OSError:
                    keep.append(False)
            yield frame[keep]

    return dates.select("dt").mapInPandas(ask, "dt date")


def monitor(round_: Callable[[], None], rounds: int | None = None, wait: Callable[[float], None] = time.sleep) -> int:
    """Runs a fetching round each POLL seconds, or POLL_FAILED after one that failed; the failed ones' number."""
    done, failed = 0, 0
    while rounds is None or done < rounds:
        try:
            round_()
            pause = POLL
        except OSError:
            failed += 1
            pause = POLL_FAILED
        done += 1
        if rounds is None or done < rounds:
            wait(pause)
    return failed
