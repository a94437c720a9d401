"""All engine queries by name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import INTERVALS
from tidelake.operators import book, bronze, diamond, evaluate, gold, klines, trades

from . import fixtures as X
from . import oracles as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, negative zero as zero: what two engines must agree on.  The shift
    keeps decimal ties at the seventh from falling either way."""
    return df.select(*[(F.round(S.col(c) + F.lit(2.3456789e-8), 6) + F.lit(0.0)).alias(c) if t == "double" else S.col(c) for c, t in df.dtypes])


def register(name: str, query: Query, oracle: str | None = None, rounded: bool = True) -> None:
    QUERIES[name] = (lambda spark, sf, q=query: tidy(q(spark, sf))) if rounded else query
    if oracle:
        ORACLES[name] = oracle


def _trades(interval: str, groups: Sequence[str]) -> Query:
    return lambda spark, sf: trades.aggregate(X.trade_feed(spark, sf), interval, groups)


CORE = ("flow", "core")
for _i in ("5m", "15m"):
    register(f"trades_core_{_i}", _trades(_i, CORE), O.trade_windows(_i, CORE))
for _i in ("1h", "4h", "1d"):
    register(f"trades_core_{_i}", lambda spark, sf, i=_i: trades.aggregate_panes(X.trade_feed(spark, sf), i), O.trade_windows(_i, CORE))
register("trades_core_1h_spread", _trades("1h", CORE), O.trade_windows("1h", CORE))
for _g in ("quantiles", "moments", "corr", "ticks", "nunique", "rate"):
    register(f"trades_{_g}_1h", _trades("1h", [_g]), O.trade_windows("1h", [_g]))
for _i in ("5m", "15m", "1h", "4h", "1d"):
    register(f"trades_all_{_i}", _trades(_i, trades.GROUPS), O.trade_windows(_i, trades.GROUPS))

register("book_features", lambda spark, sf: X.book_rows(spark, sf), f"WITH {O.BOOK} SELECT ts, {', '.join(f'{O.r(c)} AS {c}' for c in O.KERNEL)} FROM book")
for _i in ("5m", "15m", "1h", "4h", "1d"):
    register(f"book_metrics_{_i}", lambda spark, sf, i=_i: book.aggregate(X.book_rows(spark, sf, before=True), i), O.book_windows(_i))

_OHLC = "open_time, " + ", ".join(f"{O.r(c)} AS {c}" for c in ("open", "high", "low", "close"))
register("klines_1m", lambda spark, sf: X.kline_feed(spark, sf), f"WITH {O.INDEX} SELECT {_OHLC} FROM idx")
register("klines_mark_1m", lambda spark, sf: X.kline_feed(spark, sf, "mark"), f"WITH {O.MARK} SELECT {_OHLC} FROM mrk")
for _i in ("5m", "1h", "1d"):
    register(
        f"klines_{_i}",
        lambda spark, sf, i=_i: klines.aggregate(X.kline_feed(spark, sf), i),
        f"WITH {O.INDEX}, {O.kline_windows('idx', _i, 'k')} SELECT window_end, {', '.join(f'{O.r(c)} AS {c}' for c in ('open', 'high', 'low', 'close', 'mean', 'std'))} FROM k",
    )
register("funding_8h", X.funding_feed, f"WITH {O.FUNDING} SELECT funding_time, {O.r('funding_rate')} AS funding_rate FROM funding")


def _base_columns(intervals: Sequence[str]) -> list[str]:
    out = []
    for i in intervals:
        out += [f"orderbook_{i}_{n}" for n in ("wmp_last", "wmp_min", "wmp_max", "wmp_mean", "spread_mean")]
        out += [f"trades_{i}_{n}" for n in ("price_mean_trade", "price_std_trade", "price_min_trade", "price_max_trade", "price_last_trade", "volume_buy", "volume_sell", "turnover_buy", "turnover_sell")]
        out += [f"index_price_{i}_{n}" for n in ("close", "mean", "std")] + [f"mark_price_{i}_mean"]
    return [*out, "funding_funding_rate"]


_TWO, _LONG = ("5m", "15m"), ("1h", "4h", "1d")
_SHOWN = ", ".join(f"{O.r(c)} AS {c}" for c in _base_columns(_TWO)) + ", " + ", ".join(f"trades_{i}_count_{s}" for i in _TWO for s in ("buy", "sell")) + ", funding_funding_time"
register("merge_full", lambda spark, sf: X.gold_base(spark, sf, fill=False), f"{O.gold(fill=False)} SELECT window_end, {_SHOWN} FROM g")
register("merge_ffill", lambda spark, sf: X.gold_base(spark, sf), f"{O.gold()} SELECT window_end, {_SHOWN} FROM g")


# Bronze repair: events filed three hours late are misplaced, every tenth is there twice.
def _filed(spark: SparkSession, sf: str) -> DataFrame:
    return X.events(spark, sf).select("event_id", "ms", "value").withColumn("file_date", bronze.event_date(F.col("ms") - 10_800_000))


def _twice(spark: SparkSession, sf: str) -> DataFrame:
    e = X.events(spark, sf).select("event_id", "ms", "value")
    again = e.where(F.col("event_id") % 10 == 0).withColumn("ingest_seq", F.lit(1)).withColumn("value", F.col("value") + 1)
    return e.withColumn("ingest_seq", F.lit(0)).unionByName(again)


_TWICE = "WITH e AS (SELECT event_id, (epoch_us(ts) // 1000) AS ms, value, 0 AS ingest_seq FROM events UNION ALL SELECT event_id, (epoch_us(ts) // 1000), value + 1, 1 FROM events WHERE event_id % 10 = 0)"
for _k, _d in (("first", ""), ("last", "DESC")):
    register(
        f"dedupe_{_k}",
        lambda spark, sf, k=_k: bronze.dedupe(_twice(spark, sf), ["event_id"], ["ingest_seq"], k),
        f"{_TWICE} SELECT event_id, ms, {O.r('value')} AS value, ingest_seq FROM e QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_seq {_d}) = 1",
    )
register(
    "dup_report",
    lambda spark, sf: bronze.duplicate_report(_twice(spark, sf), ["event_id"]),
    f"{_TWICE} SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT event_id, count(*) AS n FROM e GROUP BY 1 HAVING count(*) > 1)",
)
_FILED = "WITH e AS (SELECT event_id, (epoch_us(ts) // 1000) AS ms, value, CAST(ts AS DATE) AS own, CAST(ts - INTERVAL 3 HOUR AS DATE) AS file_date FROM events)"
register(
    "misplaced_rows",
    lambda spark, sf: bronze.misplaced(_filed(spark, sf), "ms", "file_date"),
    f"{_FILED} SELECT event_id, ms, {O.r('value')} AS value, file_date, own AS target_date FROM e WHERE own <> file_date",
)
register(
    "misplaced_months",
    lambda spark, sf: bronze.misplaced(_filed(spark, sf), "ms", "file_date", "month"),
    f"{_FILED} SELECT event_id, ms, {O.r('value')} AS value, file_date, CAST(date_trunc('month', own) AS DATE) AS target_date FROM e WHERE date_trunc('month', own) <> date_trunc('month', file_date)",
)


def _routed(spark: SparkSession, sf: str, month: bool) -> DataFrame:
    date = (bronze.event_month if month else bronze.event_date)(F.col("ms"))
    return X.events(spark, sf).groupBy(date.alias("dt")).agg(F.count(F.lit(1)).alias("n"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"))


for _n, _m in (("day", False), ("month", True)):
    register(
        f"route_by_{_n}",
        lambda spark, sf, m=_m: _routed(spark, sf, m),
        f"SELECT CAST(date_trunc('{_n}', ts) AS DATE) AS dt, count(*) AS n, min((epoch_us(ts) // 1000)) AS first_ms, max((epoch_us(ts) // 1000)) AS last_ms FROM events GROUP BY 1",
    )
_TEN = 600_000
register(
    "gaps_internal",
    lambda spark, sf: bronze.gaps_within(X.events(spark, sf), "ms", _TEN),
    f"SELECT ms + 1 AS gap_start, nxt - 1 AS gap_end, nxt - ms AS gap_ms FROM (SELECT (epoch_us(ts) // 1000) AS ms, lead((epoch_us(ts) // 1000)) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts) AS nxt FROM events) WHERE nxt - ms > {_TEN}",
)
register(
    "gaps_boundary",
    lambda spark, sf: bronze.gaps_between(X.events(spark, sf), "ms", 60_000),
    "SELECT hi + 1 AS gap_start, nxt - 1 AS gap_end, nxt - hi AS gap_ms FROM (SELECT hi, lead(lo) OVER (ORDER BY d) AS nxt FROM (SELECT CAST(ts AS DATE) AS d, min((epoch_us(ts) // 1000)) AS lo, max((epoch_us(ts) // 1000)) AS hi FROM events GROUP BY 1)) WHERE nxt - hi > 60000",
)
_START = 1_703_980_800_000
register(
    "gaps_prehistory",
    lambda spark, sf: bronze.gap_before(X.events(spark, sf), "ms", _START),
    f"SELECT CAST({_START} AS BIGINT) AS gap_start, min((epoch_us(ts) // 1000)) - 1 AS gap_end, min((epoch_us(ts) // 1000)) - {_START} AS gap_ms FROM events HAVING min((epoch_us(ts) // 1000)) > {_START}",
)
register(
    "missing_days",
    lambda spark, sf: bronze.missing_days(X.events(spark, sf).where("pmod(floor(ms / 86400000), 7) != 3"), "ms", "2023-12-30", "2024-02-02"),
    "SELECT d AS missing_date FROM (SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS d) WHERE d NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE (epoch_us(ts) // 1000) // 86400000 % 7 <> 3)",
)
register(
    "upsert_last",
    lambda spark, sf: bronze.merge_rows(
        X.events(spark, sf).select("event_id", "value"), X.events(spark, sf).where("event_id % 3 = 0").select(F.col("event_id") + F.lit(1), (F.col("value") * 2).alias("value")).toDF("event_id", "value"), ["event_id"]
    ),
    f"WITH n AS (SELECT event_id + 1 AS event_id, value * 2 AS value FROM events WHERE event_id % 3 = 0) SELECT event_id, {O.r('value')} AS value FROM n UNION ALL SELECT event_id, {O.r('value')} AS value FROM events WHERE event_id NOT IN (SELECT event_id FROM n)",
)


# Gold
def _derived(names: Sequence[str], intervals: Sequence[str] = _TWO, extended: bool = False, rename: dict[str, str] | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        got = gold.derive(X.gold_base(spark, sf, intervals, depth=extended), intervals=intervals, extended=extended)
        plain = [n for n in names if n.startswith("hour_")]
        each = [(f"feat_{n}_{i}", f"feat_{(rename or {}).get(n, n)}_{i}") for i in intervals for n in names if n not in plain]
        return got.select("window_end", *[S.col(a).alias(b) for a, b in each], *[f"feat_{n}" for n in plain])

    return run


_FAMILIES: dict[str, tuple[Sequence[str], Sequence[str], Sequence[str], bool]] = {
    # name: shown first-level features, second-level ones, helpers, extended
    "basis": (("basis_spread", "basis_ratio", "premium_index"), (), (), False),
    "logret": (("log_return_trade", "log_return_index"), ("trend_divergence",), (), False),
    "funding": (("funding_cost", "funding_trend"), ("funding_basis_corr",), ("basis_ratio",), False),
    "momentum": (("price_velocity", "ma_divergence", "rsi_proxy"), ("price_accel",), (), False),
    "volatility": (("volatility_spread", "rel_spread", "candle_range", "tail_extension"), (), (), False),
    "efficiency": (("price_entropy",), ("efficiency_ratio",), ("path",), False),
    "zscore": (("z_spread",), (), (), False),
    "orderflow_ext": (("trade_imbalance", "aggressiveness", "buy_consumption", "sell_consumption", "depth_imbalance", "z_volume"), ("smart_money_div", "z_imbalance"), (), True),
    "shape_ext": (("bid_slope", "ask_slope", "depth_convexity", "liq_density"), ("slope_imbalance",), (), True),
    "vwap_ext": (("dist_vwap", "dist_max", "dist_min"), (), (), True),
}
for _n, (_a, _b, _h, _x) in _FAMILIES.items():
    register(f"derive_{_n}", _derived((*_a, *_b), extended=_x), O.derived((*_a, *_h), _b, _a, depth=_x))
    register(f"derive_{_n}_long", _derived((*_a, *_b), _LONG, extended=_x), O.derived((*_a, *_h), _b, _a, _LONG, depth=_x))
register("derive_time", _derived(("hour_sin", "hour_cos"), ("5m",)), O.derived((), (), intervals=("5m",), hours=True))
register("derive_kaufman_ext", _derived(("efficiency_ratio",), extended=True, rename={"efficiency_ratio": "kaufman_ratio"}), O.derived(("path", "move12"), ("kaufman_ratio",), (), depth=True))

_BASES = ("log_return_trade", "basis_ratio")
_D = O.derived(_BASES, (), intervals=("5m", "15m", "1h")).rsplit("\nSELECT ", 1)[0]


def _lagged(keep: Callable[[str], bool], intervals: Sequence[str] = ("5m", "15m", "1h")) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        base = X.gold_base(spark, sf, intervals)
        feats = [f"feat_{b}_{i}" for i in intervals for b in _BASES]
        d = gold.derive(base, intervals=intervals).select("window_end", *feats)
        out = gold.lags(d, intervals=intervals)
        return out.select("window_end", *[S.col(c) for c in out.columns if c not in feats and keep(c)])

    return run


def _lag_sql() -> str:
    return ", ".join(f"{O.r(O.lag(f'feat_{b}_{i}', k))} AS feat_{b}_{i}_lag_{n}" for i in ("5m", "15m", "1h") for b in _BASES for k, n in gold.LAGS[i])


def _special_sql() -> str:
    out = []
    for i in ("5m", "15m", "1h"):
        x, b = f"feat_log_return_trade_{i}", f"feat_basis_ratio_{i}"
        near, far = gold.LAGS[i][0][0], gold.LAGS[i][-2][0]
        out += [f"{O.r(f'{x} * {O.lag(x, near)}')} AS feat_momentum_persistence_{i}", f"{O.r(f'{x} - {O.lag(x, near)}')} AS feat_momentum_acceleration_{i}", f"{O.r(f'{b} - {O.lag(b, far)}')} AS feat_basis_expansion_{i}"]
    return ", ".join(out)


def _rolling_sql() -> str:
    out = []
    for i in ("5m", "15m", "1h"):
        for b in _BASES:
            x = f"feat_{b}_{i}"
            out += [f"{O.r(O.roll(x, n, fn))} AS {x}_roll_{w}_{n}p" for n, w, fn in ((3, "mean", "avg"), (6, "mean", "avg"), (3, "std", "stddev_samp"))]
            out.append(f"{O.r(O.div(f'{x} - ({O.roll(x, 3)})', O.roll(x, 3, 'stddev_samp')))} AS {x}_vs_trend_z")
    return ", ".join(out)


register("lags_basic", _lagged(lambda c: "_lag_" in c), f"{_D} SELECT window_end, {_lag_sql()} FROM d")
register("lags_special", _lagged(lambda c: any(x in c for x in ("_persistence_", "_acceleration_", "_expansion_"))), f"{_D} SELECT window_end, {_special_sql()} FROM d")
register(
    "lags_cross",
    _lagged(lambda c: "_alignment_" in c or "_divergence_" in c),
    f"{_D} SELECT window_end, {O.r('feat_log_return_trade_5m * feat_log_return_trade_1h')} AS feat_momentum_alignment_5m_1h, {O.r('feat_log_return_trade_5m - feat_log_return_trade_1h')} AS feat_momentum_divergence_5m_1h FROM d",
)
register("lags_rolling", _lagged(lambda c: "_roll_" in c or "_trend_z" in c), f"{_D} SELECT window_end, {_rolling_sql()} FROM d")


# All seventeen lagged features, and what compares them, one interval a query; pairs of intervals in one more.
def _all_lagged(i: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feats = [f"feat_{b}_{i}" for b in gold.LAGGED]
        d = gold.derive(X.gold_base(spark, sf, (i,), depth=True), intervals=(i,), extended=True).select("window_end", *[S.col(c) for c in feats])
        out = gold.lags(d, intervals=(i,))
        return out.select("window_end", *[S.col(c) for c in out.columns if c not in feats and c != "window_end"])

    return run


def _all_lagged_sql(i: str) -> str:
    first = [b for b in gold.LAGGED if b != "smart_money_div"]
    head = O.derived((*first,), (), (), (i,), depth=True).rsplit("\nSELECT ", 1)[0]
    f = lambda n: f"feat_{n}_{i}"
    cols = [f"{O.r(O.lag(f(b), k))} AS {f(b)}_lag_{n}" for b in gold.LAGGED for k, n in gold.LAGS[i]]
    near, far = gold.LAGS[i][0][0], gold.LAGS[i][-2][0]
    x, t, b = f("log_return_trade"), f("trade_imbalance"), f("basis_ratio")
    cols += [f"{O.r(f'{x} * {O.lag(x, near)}')} AS {f('momentum_persistence')}", f"{O.r(f'{x} - {O.lag(x, near)}')} AS {f('momentum_acceleration')}"]
    cols += [f"{O.r(f'{t} * {O.lag(t, near)}')} AS {f('flow_persistence')}", f"{_tiny(f'{t} > 0 AND {O.lag(t, near)} < 0')} AS {f('flow_reversal_bullish')}", f"{_tiny(f'{t} < 0 AND {O.lag(t, near)} > 0')} AS {f('flow_reversal_bearish')}"]
    cols.append(f"{O.r(f'{b} - {O.lag(b, far)}')} AS {f('basis_expansion')}")
    if i in ("5m", "15m", "1h"):
        for n in (f(b) for b in gold.ROLLED):
            cols += [f"{O.r(O.roll(n, k, fn))} AS {n}_roll_{w}_{k}p" for k, w, fn in ((3, "mean", "avg"), (6, "mean", "avg"), (3, "std", "stddev_samp"))]
            cols.append(f"{O.r(O.div(f'{n} - ({O.roll(n, 3)})', O.roll(n, 3, 'stddev_samp')))} AS {n}_vs_trend_z")
    return f"{head}, e AS (SELECT *, {O.second_sql('smart_money_div', i)} AS {f('smart_money_div')} FROM d) SELECT window_end, {', '.join(cols)} FROM e"


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    feats = [f"feat_{b}_{i}" for i in INTERVALS for b in ("log_return_trade", "trade_imbalance")]
    d = gold.derive(X.gold_base(spark, sf, INTERVALS), intervals=INTERVALS, extended=True).select("window_end", *[S.col(c) for c in feats])
    out = gold.lags(d, intervals=INTERVALS)
    return out.select("window_end", *[S.col(c) for c in out.columns if "_alignment_" in c or "_divergence_" in c])


def _pairs_sql() -> str:
    cols = []
    for a, b in gold.PAIRS:
        x, y, t, u = (f"feat_{n}_{i}" for n in ("log_return_trade", "trade_imbalance") for i in (a, b))
        cols += [f"{O.r(f'{x} * {y}')} AS feat_momentum_alignment_{a}_{b}", f"{O.r(f'{x} - {y}')} AS feat_momentum_divergence_{a}_{b}", f"{O.r(f'{t} * {u}')} AS feat_flow_alignment_{a}_{b}"]
    return O.derived(("log_return_trade", "trade_imbalance"), (), (), INTERVALS).rsplit("\nSELECT ", 1)[0] + f" SELECT window_end, {', '.join(cols)} FROM d"


def _tiny(x: str) -> str:
    return f"CAST({x} AS TINYINT)"


for _i in INTERVALS:
    register(f"lags_all_{_i}", _all_lagged(_i), _all_lagged_sql(_i))
register("lags_pairs", _pairs, _pairs_sql())


def _labels(kind: str, intervals: Sequence[str] = _TWO) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        base = X.gold_base(spark, sf, intervals).select("window_end", *[f"orderbook_{i}_wmp_last" for i in intervals])
        out = gold.labels(base, [kind], intervals=intervals)
        return out.select("window_end", *[S.col(c) for c in out.columns if c not in base.columns])

    return run


def _rise(i: str, k: int = 1) -> str:
    w = f"orderbook_{i}_wmp_last"
    return O.div(f"lead({w}, {k}) {O.O} - {w}", w)


def _label_sql(kind: str, intervals: Sequence[str] = _TWO) -> str:
    out = []
    for i in intervals:
        w, x = f"orderbook_{i}_wmp_last", f"r_{i}"
        if kind == "optimal":
            out.append(f"{_tiny(f'{x} > {gold.THRESHOLDS[i]}::DOUBLE')} AS label_{i}")
        if kind == "simple":
            ahead = f"lead({w}) {O.O}"
            out += [f"{O.r(ahead)} AS {w}_future_1p", f"{O.r(x)} AS return_{i}", f"{O.r(f'abs({x})')} AS return_abs_{i}", f"{_tiny(f'{ahead} > {w}')} AS label_{i}"]
        if kind == "multi":
            for k, n in gold.LEADS.get(i, ()):
                out += [f"{O.r(_rise(i, k))} AS return_{i}_{n}", f"{_tiny(f'lead({w}, {k}) {O.O} > {w}')} AS label_{i}_{n}"]
        if kind == "cat":
            t = f"{gold.CLASSES[i]}::DOUBLE"
            out.append(f"{_tiny(f'CASE WHEN {x} > {t} THEN 3 WHEN {x} > 0 THEN 2 WHEN {x} >= -{t} THEN 1 ELSE 0 END')} AS label_cat_{i}")
        if kind == "voladj" and i in ("5m", "15m", "1h"):
            v = O.roll(x, 24, "stddev_samp")
            a = O.div(x, v)
            out += [f"{O.r(v)} AS vol_{i}_24p", f"{O.r(a)} AS return_vol_adj_{i}", f"{_tiny(f'({a}) > 0')} AS label_vol_adj_{i}", f"{_tiny(f'abs({a}) > 1')} AS label_strong_move_{i}"]
    returns = ", ".join(f"{_rise(i)} AS r_{i}" for i in intervals)
    return f"{O.gold(intervals)}, x AS (SELECT window_end, {', '.join(f'orderbook_{i}_wmp_last' for i in intervals)}, {returns} FROM g) SELECT window_end, {', '.join(out)} FROM x"


for _k in ("optimal", "simple", "multi", "cat", "voladj"):
    register(f"labels_{_k}", _labels(_k), _label_sql(_k))
    register(f"labels_{_k}_long", _labels(_k, _LONG), _label_sql(_k, _LONG))
register(
    "label_distribution",
    lambda spark, sf: gold.label_distribution(_labels("optimal")(spark, sf)),
    f"WITH y AS ({_label_sql('optimal')}) " + " UNION ALL ".join(f"SELECT 'label_{i}' AS label, count(label_{i}) AS n, count(*) - count(label_{i}) AS nulls, {O.r(f'avg(label_{i})')} AS share FROM y" for i in _TWO),
)


# Diamond
def _clean(spark: SparkSession, sf: str) -> DataFrame:
    cols = [c for c in _base_columns(_TWO) if not c.startswith("mark_")]
    return diamond.complete(X.gold_base(spark, sf).select("window_end", *cols))


_CLEAN_COLUMNS = [c for c in _base_columns(_TWO) if not c.startswith("mark_")]
_CLEAN = f"{O.gold()}, c AS (SELECT window_end, {', '.join(_CLEAN_COLUMNS)} FROM g WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ('window_end', *_CLEAN_COLUMNS))})"
_CLEAN_SHOWN = ", ".join(f"{O.r(c)} AS {c}" for c in _CLEAN_COLUMNS)
register("diamond_nonnull", _clean, f"{_CLEAN} SELECT window_end, {_CLEAN_SHOWN} FROM c")
for _i in ("15m", "1h", "4h", "1d"):
    register(
        f"diamond_downsample_{_i}",
        lambda spark, sf, i=_i: diamond.downsample(_clean(spark, sf), i),
        f"{_CLEAN} SELECT window_end, {_CLEAN_SHOWN} FROM c QUALIFY (row_number() OVER (ORDER BY window_end) - 1) % {O.SIZES[_i] // O.S} = 0",
    )
register("diamond_clock_1h", lambda spark, sf: diamond.downsample(_clean(spark, sf), "1h", align="clock"), f"{_CLEAN} SELECT window_end, {_CLEAN_SHOWN} FROM c WHERE window_end % 3600000 = 0")

# The five training sets: base columns, returns, basis and labels of all intervals, complete rows, each set its own columns.
_SET_FEATURES = ("log_return_trade", "basis_ratio", "candle_range")


def _gold_frame(spark: SparkSession, sf: str) -> DataFrame:
    base = gold.derive(X.gold_base(spark, sf, INTERVALS), intervals=INTERVALS)
    base = gold.labels(base, ["optimal"], intervals=INTERVALS)
    names = [*_base_columns(INTERVALS), *(f"feat_{n}_{i}" for i in INTERVALS for n in _SET_FEATURES), "feat_hour_sin", "feat_hour_cos", *(f"label_{i}" for i in INTERVALS)]
    return base.select("window_end", *[S.col(c) for c in names if not c.startswith("mark_")])


def _set_sql(interval: str) -> str:
    bases = [c for c in _base_columns(INTERVALS) if not c.startswith("mark_")]
    feats = [f"feat_{n}_{i}" for i in INTERVALS for n in _SET_FEATURES]
    head = O.derived(_SET_FEATURES, (), (), INTERVALS).rsplit("\nSELECT ", 1)[0]
    hours = ", ".join(f"{fn}(2 * pi() * (window_end // 3600000 % 24) / 24) AS feat_hour_{fn}" for fn in ("sin", "cos"))
    marks = ", ".join(f"{_tiny(f'({_rise(i)}) > {gold.THRESHOLDS[i]}::DOUBLE')} AS label_{i}" for i in INTERVALS)
    every = [*bases, *feats, "feat_hour_sin", "feat_hour_cos", *(f"label_{i}" for i in INTERVALS)]
    shorter = INTERVALS[: INTERVALS.index(interval)]
    # a set leaves out what is of shorter intervals only, and labels but its own
    mine = [c for c in every if (c == f"label_{interval}" if c.startswith("label_") else c.startswith(("funding_", "feat_hour_")) or (not c.startswith("feat_") and not any(f"_{j}_" in c for j in shorter)))]
    shown = ", ".join(c if c.startswith("label_") else f"{O.r(c)} AS {c}" for c in mine)
    return (
        f"{head}, y AS (SELECT *, {hours}, {marks} FROM d), c AS (SELECT * FROM y WHERE {' AND '.join(f'{c} IS NOT NULL' for c in every)}) "
        f"SELECT window_end, {shown} FROM c QUALIFY (row_number() OVER (ORDER BY window_end) - 1) % {O.SIZES[interval] // O.S} = 0"
    )


for _i in INTERVALS:
    register(f"diamond_dataset_{_i}", lambda spark, sf, i=_i: diamond.dataset(_gold_frame(spark, sf), i), _set_sql(_i))

# Model side
_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
register(
    "ml_corr_pairs",
    lambda spark, sf: evaluate.correlations(spark.read.parquet(f"{sf}/lineitem.parquet"), _NUMBERS),
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {O.r(f'corr({a}, {b})')} AS r FROM lineitem" for k, a in enumerate(sorted(_NUMBERS)) for b in sorted(_NUMBERS)[k + 1 :]),
)
register(
    "ml_folds",
    lambda spark, sf: evaluate.fold_table(spark.read.parquet(f"{sf}/events.parquet"), 2000, 1000, 350),
    "SELECT (s - 2000) // 350 AS fold, CAST(s AS BIGINT) AS train_end, CAST(s AS BIGINT) AS test_start, least(s + 1000, n) AS test_end FROM (SELECT n, unnest(range(2000, n - 1000, 350)) AS s FROM (SELECT count(*) AS n FROM events)) WHERE least(s + 1000, n) - s >= 800",
)
register(
    "ml_metrics",
    lambda spark, sf: evaluate.metrics(spark.read.parquet(f"{sf}/labels.parquet"), "quality", "toxic"),
    f"SELECT count(*) AS n, {O.r('count(*) FILTER (WHERE quality = toxic) / count(*)')} AS accuracy, {O.r('coalesce(count(*) FILTER (WHERE quality = 1 AND toxic = 1) / nullif(count(*) FILTER (WHERE toxic = 1), 0), 0)')} AS precision, {O.r('coalesce(count(*) FILTER (WHERE quality = 1 AND toxic = 1) / nullif(count(*) FILTER (WHERE quality = 1), 0), 0)')} AS recall FROM labels",
)
register(
    "ml_pnl",
    lambda spark, sf: evaluate.profit(spark.read.parquet(f"{sf}/labels.parquet").withColumn("ret", (F.col("doc_id") % 7 - 3) / 1000), "quality", "ret"),
    f"SELECT count(*) FILTER (WHERE quality = 1) AS trades, {O.r('coalesce(sum((doc_id % 7 - 3) / 1000 - 0.0004::DOUBLE) FILTER (WHERE quality = 1), 0)')} AS pnl, count(*) FILTER (WHERE quality = 1 AND (doc_id % 7 - 3) / 1000 - 0.0004::DOUBLE > 0) AS wins FROM labels",
)
