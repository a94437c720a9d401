"""Windows out of panes: the values of windows whose rows are copied, without the copies."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidelake.functions.intervals import to_ms
from tidelake.operators import book, klines, trades
from tidelake.operators import windows as W
from tidelake.plans import fixtures, registry

M = 60_000


def near(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-8, abs_tol=1e-8))


def agree(ours, theirs, columns):
    a, b = ({(r["g"], r["window_end"]): r for r in df.collect()} for df in (ours, theirs))
    assert a.keys() == b.keys() and a
    for k in a:
        assert {c: (a[k][c], b[k][c]) for c in columns if not near(a[k][c], b[k][c])} == {}, k


def tape(spark, n=1500):
    """Bursts, long pauses, a day without rows, equal times, a calm stretch of one price, missing values, sides and keys."""
    r = random.Random(9)
    rows, t = [], 0
    for k in range(n):
        t += r.choice([0, 1, 700, 20_000, 400_000]) if k % 400 else 30 * 60 * M * r.randrange(1, 60)
        price = 5.0 if 300 < k < 420 else r.choice([None, *[1e4 + x / 100 for x in range(60)]])
        rows.append((k, r.choice("ab"), t, r.choice(["buy", "sell", "other", None]), price, r.choice([None, 1.0, 2.0, 7.5])))
    return spark.createDataFrame(rows, "trade_id long, g string, created_time long, side string, price double, size double")


@pytest.mark.parametrize("interval", ["15m", "4h", "1d"])
def test_trades_equal_windows_of_copied_rows(spark, interval):
    size, df = to_ms(interval), tape(spark)
    got = trades.aggregate(df, interval, keys=["g"])
    rows = W.on_source_days(W.spread(trades.prepare(df, ["g"]), "created_time", size), W.source_days(df, "created_time", ["g"]), ["g"])
    plain = rows.groupBy("g", "window_end").agg(*trades.metrics(size))
    assert got.columns == plain.columns
    agree(got, plain, plain.columns)


@pytest.mark.parametrize("interval", ["15m", "1d"])
def test_books_equal_windows_of_copied_rows(spark, interval):
    size = to_ms(interval)
    names = [*book.FEATURES, "best_bid"]
    df = tape(spark).select("g", F.col("created_time").alias("ts"), F.col("trade_id").alias("seq"), *[(F.xxhash64("trade_id", F.lit(k)) % 1000 / 7.0).alias(n) for k, n in enumerate(names)])
    got = book.aggregate(df, interval, keys=["g"], lasts=["best_bid"])
    rows = W.with_previous(df, "ts", ["ts", "seq"], {"_prev_t": F.col("ts")}, ["g"]).withColumns({"_first": F.struct("ts", "seq"), "_last": F.struct("ts", -F.col("seq"))})
    rows = W.on_source_days(W.spread(rows, "ts", size), W.source_days(rows, "ts", ["g"]), ["g"])
    plain = rows.groupBy("g", "window_end").agg(*book.metrics(size), F.max_by("best_bid", "_last").alias("best_bid"))
    assert len(got.columns) == 80 and set(got.columns) == set(plain.columns)
    agree(got, plain, plain.columns)


@pytest.mark.parametrize("name", ["trades_all_1d", "book_metrics_1d", "derive_volatility_long", "diamond_dataset_1d"])
def test_no_raw_row_is_copied_to_its_windows(spark, sf, name):
    """Below each copying to windows, rows have been aggregated."""
    lines = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda s: len(s) - len(s.lstrip(" :+-*"))
    copies = [i for i, s in enumerate(lines) if "Generate explode(" in s and "sequence(" in s]
    assert copies
    for i in copies:
        below = []
        for s in lines[i + 1 :]:
            if not s.strip() or depth(s) < depth(lines[i]):
                break
            below.append(s)
        chain = below[: next((k for k, s in enumerate(below) if "Join" in s), len(below))]
        assert any("Aggregate(" in s for s in chain), lines[i][:200]


@pytest.mark.parametrize("interval", ["5m", "1h"])
def test_only_what_is_asked_for(spark, sf, interval):
    feed = fixtures.trade_feed(spark, sf)
    assert set(trades.aggregate(feed, interval, ["flow", "core"], only=("price_mean_buy", "count_sell")).columns) == {"window_end", "price_mean_buy", "count_sell"}
    assert set(book.aggregate(fixtures.book_rows(spark, sf), interval, only=("wmp_mean",), lasts=("best_bid",)).columns) == {"window_end", "wmp_mean", "best_bid"}


@pytest.mark.parametrize(("name", "column"), [("book_metrics_1d", "weighted_mid_price"), ("book_metrics_5m", "best_bid"), ("trades_all_1d", "turnover")])
def test_rows_are_shuffled_slim(spark, sf, name, column):
    """Raw rows are dealt out before features, turnover and neighbours are worked out; only aggregates hold them after that."""
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        lines = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    at = [i for i, s in enumerate(lines) if "Exchange hashpartitioning(_piece" in s]
    assert at
    for i in at:
        assert "Project [" in lines[i + 1] and f"AS {column}#" not in lines[i + 1] and "struct(" not in lines[i + 1] and f" {column}#" not in lines[i + 1], lines[i + 1][:300]


def test_snapshots_of_a_pane_are_dealt_to_one_task(spark, sf):
    """So each pane is one row in the shuffle of panes, however many tasks there are."""
    rows = fixtures.book_feed(spark, sf).select(F.spark_partition_id().alias("p"), W.pane_of(F.col("ts")).alias("pane"))
    tasks, panes, pairs = rows.agg(F.countDistinct("p"), F.countDistinct("pane"), F.countDistinct("p", "pane")).first()
    assert tasks > 1 and pairs == panes


@pytest.mark.parametrize("name", ["diamond_dataset_15m", "diamond_dataset_1h"])
def test_snapshots_are_dealt_out_once_for_all_intervals(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    assert sum("Exchange hashpartitioning" in s and "REPARTITION_BY_NUM" in s and "ReusedExchange" not in s for s in lines) == 1


def test_five_minutes_without_a_time_have_no_window(spark):
    at = spark.createDataFrame([(1, "buy", None, 1.0, 1.0), (2, "buy", 10, 1.0, 1.0)], "trade_id long, side string, created_time long, price double, size double")
    assert [r[0] for r in trades.aggregate(at, "5m", ["flow"]).select("window_end").collect()] == [5 * M]
    snaps = at.select(F.col("created_time").alias("ts"), *[F.col("price").alias(n) for n in book.FEATURES])
    assert [r[0] for r in book.aggregate(snaps, "5m").select("window_end").collect()] == [5 * M]


@pytest.mark.parametrize("interval", ["5m", "15m", "1d"])
@pytest.mark.parametrize("candle", [M, 7 * M])
def test_candles_equal_windows_of_copied_rows(spark, interval, candle):
    """Also where the only candle of a day closes on the next, which has none, and where closes are no finite numbers."""
    r, day = random.Random(4), 24 * 60 * M
    opens = sorted({x // candle * candle for d in (0, 1, 4) for x in (r.randrange(d * day, d * day + day) for _ in range(150))} | {7 * day - candle, 9 * day, 12 * day - candle, 12 * day})
    price = lambda: r.choice([None, 5.0, 5.0, float("nan"), float("inf"), *[1e4 + x / 100 for x in range(60)]])
    rows = [(g, t, *(price() for _ in range(4))) for g in "ab" for t in opens if g == "a" or t < 9 * day]
    df = spark.createDataFrame([*rows, ("b", None, 1.0, 1.0, 1.0, 1.0)], "g string, open_time long, open double, high double, low double, close double")
    at = df.withColumn("close_time", F.col("open_time") + F.lit(candle))
    plain = W.on_source_days(W.spread(at, "close_time", to_ms(interval)), W.source_days(df, "open_time", ["g"]), ["g"]).groupBy("g", "window_end").agg(*klines.metrics()).where("open is not null")
    got = klines.aggregate(df, interval, ["g"], candle=candle)
    assert got.columns == plain.columns
    odd = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    text = lambda x: x.select("g", "window_end", *[F.when(~odd(c), F.col(c)).alias(c) for c in klines.NAMES], *[F.when(odd(c), F.col(c).cast("string")).alias(f"{c}_odd") for c in klines.NAMES])
    got, plain = text(got), text(plain)
    agree(got, plain, plain.columns)


def written(plan) -> int:
    """Rows that the exchanges of a plan that ran have written, those that are used again once."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return written(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return written(plan.plan())
    if kind == "ReusedExchangeExec":
        return 0
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(written(plan.children().apply(i)) for i in range(plan.children().size()))


@pytest.mark.parametrize("name", ["klines_1d", "diamond_dataset_15m"])
def test_no_copied_candle_is_shuffled(spark, sf, name):
    """Not even where no table is broadcast: whether a small table is ready in time must not decide what is written."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.QUERIES[name](spark, sf)
        df.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    candles = registry.QUERIES["klines_1m"](spark, sf).count()
    assert written(df._jdf.queryExecution().executedPlan()) < 288 * candles
