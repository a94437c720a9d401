"""Golden cases and properties of the engine, and every registered query against DuckDB on the smallest tables."""

import glob
import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import to_ms
from tidelake.operators import book, bronze, diamond, evaluate, gold, klines, trades
from tidelake.operators import windows as W
from tidelake.plans import fixtures, registry

M = 60_000


def tape(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "trade_id long, created_time long, side string, price double, size double")


def by_end(df):
    return {r["window_end"]: r for r in df.collect()}


def test_intervals():
    assert [to_ms(x) for x in ("5m", "4H", "1d")] == [300_000, 14_400_000, 86_400_000]
    assert to_ms("odd", lenient=True) == 60_000
    with pytest.raises(ValueError):
        to_ms("odd")


def test_window_edges(spark):
    day = 86_400_000
    got = by_end(trades.aggregate(tape(spark, [(5 * M, "buy", 1.0, 1.0), (day - 1, "sell", 2.0, 1.0)]), "5m", ["flow"]))
    assert sorted(got) == [10 * M, day]  # a trade at a window's end is in the next; the last window of a day ends at midnight
    assert got[day]["count_sell"] == 1
    one_day = trades.aggregate(tape(spark, [(23 * 60 * M, "buy", 1.0, 1.0)]), "1d", ["flow"])
    assert one_day.count() == 12 and one_day.agg(F.max("window_end")).first()[0] == day  # no windows on a day without rows


def test_one_row_and_constant_prices(spark):
    one = by_end(trades.aggregate(tape(spark, [(M, "buy", 5.0, 2.0)]), "5m"))[5 * M]
    assert one["price_std_trade"] is None and one["price_skew_trade"] is None and one["corr_price_size_trade"] is None
    assert (one["count_tick_up"], one["volume_sell"], one["price_mean_sell"], one["nunique_price_sell"]) == (0, 0.0, None, 0)
    flat = by_end(trades.aggregate(tape(spark, [(k * M, "sell", 3.0, float(k)) for k in range(3)]), "5m"))[5 * M]
    assert flat["price_std_trade"] == 0.0 and flat["corr_price_size_trade"] is None and flat["price_kurtosis_trade"] is None
    assert len(flat) - 1 == 91


def test_quantiles_and_moments(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 4.0, 9.0, 7.0)], "x double")
    q = df.agg(*[S.quantile(F.col("x"), p).alias(str(i)) for i, p in enumerate((0.25, 0.5, 0.75))]).first()
    assert tuple(q) == (2.0, 4.0, 7.0)
    assert df.where("x < 3").agg(S.quantile(F.col("x"), 0.5)).first()[0] == 2.0
    m = df.agg(F.skewness("x"), F.kurtosis("x"), F.stddev_samp("x")).first()
    assert m[0] == pytest.approx(0.2543027658961977) and m[1] == pytest.approx(-1.4783068368705454) and m[2] == pytest.approx(3.361547262794322)


def test_previous_row_counts_only_inside_the_window(spark):
    got = by_end(trades.aggregate(tape(spark, [(4 * M, "buy", 1.0, 1.0), (6 * M, "buy", 2.0, 1.0), (7 * M, "sell", 1.0, 1.0)]), "5m", ["ticks", "rate"]))
    assert (got[10 * M]["count_tick_up"], got[10 * M]["count_tick_down"]) == (0, 1)
    assert got[10 * M]["rate_mean_ms_trade"] == M and got[10 * M]["rate_mean_ms_buy"] is None


@pytest.mark.parametrize("interval", ["5m", "1h", "1d"])
def test_panes_equal_spread(spark, sf, interval):
    feed = fixtures.trade_feed(spark, sf)
    a = registry.tidy(trades.aggregate(feed, interval, ["flow", "core"]))
    b = registry.tidy(trades.aggregate_panes(feed, interval)).select(*[S.q(c) for c in a.columns])
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_window_properties(spark, sf):
    feed = fixtures.trade_feed(spark, sf)
    five = trades.aggregate(feed, "5m", ["flow"])
    assert five.agg(F.sum("trade_count")).first()[0] == feed.count()
    quarter = trades.aggregate(feed, "15m", ["flow"]).select("window_end", F.col("trade_count").alias("n"))
    sums = five.select(F.explode(F.array(*[F.col("window_end") + k * 5 * M for k in range(3)])).alias("window_end"), "trade_count").groupBy("window_end").agg(F.sum("trade_count").alias("s"))
    assert quarter.join(sums, "window_end").where("n <> s").isEmpty()


def test_book_with_few_levels(spark):
    row = [(0, "snapshot", '[["101","1"],["102","2"],["103","3"]]', '[["100","4"],["99","bad"]]'), (1, "update", "[]", "[]"), (2, "snapshot", "[]", "not json")]
    f = book.features(spark.createDataFrame(row, "ts long, action string, asks string, bids string")).collect()
    assert len(f) == 1 and f[0]["ask_px_20"] == 101.0 and f[0]["impact_slope_ask"] == 0.0 and f[0]["sum_bid_50"] == 4.0
    assert len(book.metrics(300_000)) == 77


def test_candle_at_the_edge(spark):
    k = spark.createDataFrame([(4 * M, 1.0, 2.0, 0.5, 1.5)], "open_time long, open double, high double, low double, close double")
    assert list(by_end(klines.aggregate(k, "5m"))) == [10 * M]


def test_fill_and_rolling(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), *[(k, float(k)) for k in range(4, 18)]], "window_end long, x double")
    filled = [r["x"] for r in gold.forward_fill(df, ["x"]).orderBy("window_end").collect()]
    assert filled[:3] == [None, 5.0, 5.0]
    rolled = [r[0] for r in df.select(gold.Series().roll("x", 12), "window_end").orderBy("window_end").collect()]
    assert rolled[13] is None and rolled[14] == pytest.approx(sum(range(4, 16)) / 12)


def test_labels_tail_and_rows_with_nan(spark):
    df = spark.createDataFrame([(k, 100.0 + k) for k in range(3)], "window_end long, orderbook_5m_wmp_last double")
    got = [r["label_5m"] for r in gold.labels(df, intervals=["5m"]).orderBy("window_end").collect()]
    assert got == [1, 1, None]
    odd = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "window_end long, x double")
    assert sorted(r["window_end"] for r in diamond.complete(odd).collect()) == [1, 3]
    back = diamond.nan_for_null(odd.withColumn("n", F.lit(1)), ["x"], "n").where("window_end = 2").first()["x"]
    assert math.isnan(back)


def test_training_columns():
    cols = ["window_end", "funding_funding_rate", "label_5m", "label_1h", "trades_5m_vwap", "trades_1h_vwap", "feat_basis_ratio_1h", "feat_basis_ratio_1h_lag_4h", "feat_momentum_alignment_5m_1h", "feat_hour_sin", "feat_funding_cost_5m"]
    assert diamond.columns_for(cols, "1h") == sorted(["window_end", "funding_funding_rate", "label_1h", "trades_1h_vwap", "feat_basis_ratio_1h_lag_4h", "feat_hour_sin", "feat_funding_cost_5m"])
    assert "feat_momentum_alignment_5m_1h" in diamond.columns_for(cols, "5m")


def test_folds_and_filters(spark):
    assert [s for s, _ in evaluate.folds(100, 50, 20, 10)] == [50, 60, 70]
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), F.rand(1).alias("c"))
    assert evaluate.correlated(df, ["a", "b", "c"]) == ["b"]
    assert evaluate.pick_important({"a": 3.0, "b": 2.0, "c": 1.0}, 0.5) == ["a", "b"]
    assert len(evaluate.pick_important({str(k): float(k) for k in range(30)}, 0.9, 20)) == 20


def test_walk_forward(spark):
    df = spark.range(240).select(F.col("id").alias("window_end"), (F.col("id") % 5).cast("double").alias("x.1"), F.rand(3).alias("y"), ((F.col("id") % 5) > 2).cast("tinyint").alias("label"))
    got = evaluate.walk_forward(df, ["x.1", "y"], "label", "window_end", evaluate.Setup(50, 120, 60, 5, 0.1, 3, 0.5, 0.5), trees=5).collect()
    assert len(got) == 2 and all(r["accuracy"] > 0.9 for r in got)
    assert all(r["features"] == ["x.1"] for r in got)  # the random column gains less than the median
    assert evaluate.summary(spark.createDataFrame(got), ["accuracy"]).first()["total_pnl"] < 0


def test_final_model_is_saved_with_its_features_and_results(spark, tmp_path):
    df = spark.range(240).select(F.col("id").alias("window_end"), (F.col("id") % 5).cast("double").alias("x.1"), F.rand(3).alias("y"), ((F.col("id") % 5) > 2).cast("tinyint").alias("label"))
    setup = evaluate.Setup(50, 120, 60, 5, 0.1, 3, 0.5, 0.5)
    model, kept = evaluate.refit(df, ["x.1", "y"], "label", setup, trees=5)
    results = evaluate.walk_forward(df, ["x.1", "y"], "label", "window_end", setup, trees=5)
    evaluate.save(model, kept, results, str(tmp_path / "m"))
    again, names = evaluate.load(spark, str(tmp_path / "m"))
    assert names == kept == ["x.1"]
    pick = lambda m: [r[0] for r in evaluate.predict(m, evaluate.with_features(df, names, "label"), 0.5).orderBy("window_end").select("probability_up").collect()]
    assert pick(again) == pick(model)
    assert spark.read.option("header", True).csv(str(tmp_path / "m" / "results")).count() == 2 and spark.read.json(str(tmp_path / "m" / "summary")).first()["accuracy_mean"] > 0.9


def test_previous_rows_and_places_over_pieces_of_time(spark):
    r = random.Random(3)
    rows = [(k, g, r.randrange(10**6), r.choice([None, 1.0, 2.0])) for k in range(500) for g in [r.choice("ab")]]
    df = spark.createDataFrame(rows, "id long, g string, t long, x double")
    got = {x["id"]: x for x in W.with_previous(df, "t", ["t", "id"], {"p": F.struct("id"), "q": F.col("x")}, ["g"], chunk=10_000).collect()}
    place = {x["id"]: x["n"] for x in W.places(df.withColumn("t", F.col("t") * 1000 + F.col("id")), "t", "n", ["g"], chunk=10**7).collect()}
    assert len(got) == len(place) == 500
    for g in "ab":
        before, known = None, None
        for n, (k, _, _, x) in enumerate(sorted((x for x in rows if x[1] == g), key=lambda x: (x[2], x[0]))):
            assert (got[k]["p"]["id"] if got[k]["p"] else None, got[k]["q"], place[k]) == (before, known, n)
            before, known = k, known if x is None else x


@pytest.mark.parametrize("name", ["trades_ticks_1h", "trades_rate_1h", "book_metrics_1h"])
def test_no_task_orders_all_raw_rows(spark, sf, name):
    """Below an exchange to one partition there are aggregates only: one row a piece of time."""
    plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [i for i, line in enumerate(plan) if "SinglePartition" in line]
    assert at and all("Aggregate" in plan[i + 1] for i in at)


def test_merge_fails_on_two_rows_of_one_time(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0)], "window_end long, x double")
    with pytest.raises(Exception, match="two rows of one time"):
        gold.merge({"a_": a, "b_": a.limit(1)}).collect()


def test_training_sets_are_written(spark, tmp_path):
    rows = [(k * 300_000, float(k), None if k == 3 else 1.0, 1) for k in range(30)]
    df = spark.createDataFrame(rows, "window_end long, orderbook_1h_wmp_last double, orderbook_5m_wmp_last double, label_1h int")
    out = diamond.write_datasets(df, str(tmp_path), ("5m", "1h"))
    small, large = spark.read.parquet(out["5m"]), spark.read.parquet(out["1h"])
    assert (small.count(), large.count()) == (29, 3)
    assert small.columns == ["orderbook_1h_wmp_last", "orderbook_5m_wmp_last", "window_end"] and large.columns == ["label_1h", "orderbook_1h_wmp_last", "window_end"]


def test_repair(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "k long, seq int, v string")
    once = bronze.dedupe(df, ["k"], ["seq"], "last")
    assert {r["v"] for r in once.collect()} == {"b", "c"}
    assert bronze.dedupe(once, ["k"], ["seq"], "last").count() == 2
    t = spark.createDataFrame([(0,), (100_000,), (110_000,)], "t long")
    gap = bronze.gaps(t, "t", 60_000, base=-5).collect()
    assert {(r["kind"], r["gap_start"], r["gap_end"]) for r in gap} == {("internal", 1, 99_999), ("prehistory", -5, -1)}


def test_merge_needs_one_shuffle(spark, sf):
    feed = fixtures.trade_feed(spark, sf)
    parts = {f"{i}_": feed.select(F.col("created_time").alias("window_end"), "price") for i in "abc"}
    plan = gold.merge(parts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_end_label(spark):
    assert str(spark.range(1).select(W.end_time(F.lit(1_704_067_200_123))).first()[0]) == "2024-01-01 00:00:00.123000"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v.isoformat()[:10] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_against_duckdb(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = registry.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    ours = sorted(([_norm(v) for v in r] for r in df.select(*[S.q(c) for c in cols]).collect()), key=repr)
    cur = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    theirs = sorted(([_norm(r[names.index(c)]) for c in cols] for r in cur.fetchall()), key=repr)
    assert ours == theirs
