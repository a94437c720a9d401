"""Gold: sources merged on time, derived features, lags, labels.

Frames are wide, so every step makes its columns in a few projections, and each
rolling value is computed once, as a column, and then referred to.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import INTERVALS

TIME = "window_end"


class Series:
    """Row-frame functions over one time-ordered series for each key."""

    def __init__(self, keys: Sequence[str] = (), time: str = TIME):
        self.w = Window.partitionBy(*keys).orderBy(time)

    def lag(self, c: str, k: int = 1) -> Column:
        return F.lag(S.col(c), k).over(self.w)

    def lead(self, c: str, k: int = 1) -> Column:
        return F.lead(S.col(c), k).over(self.w)

    def roll(self, c: str, n: int, how: str = "mean") -> Column:
        """Over n rows with this one last; null until n values are there."""
        f = self.w.rowsBetween(-(n - 1), 0)
        agg = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}[how]
        return F.when(F.count(S.col(c)).over(f) == n, agg(S.col(c)).over(f))

    def fill(self, c: str) -> Column:
        return F.last(S.col(c), ignorenulls=True).over(self.w.rowsBetween(Window.unboundedPreceding, 0))


def merge(sources: dict[str, DataFrame], keys: Sequence[str] = (), time: str = TIME) -> DataFrame:
    """Full outer join of all sources on time, columns prefixed by source, in one shuffle.

    Each source must have one row a time (and key), and the job fails where one has two; the
    rows are united and the single value of each column is taken per time.
    """
    parts = []
    for k, (prefix, df) in enumerate(sources.items()):
        parts.append(df.select(*keys, time, *[S.col(c).alias(prefix + c) for c in df.columns if c not in (*keys, time)], F.lit(k).alias("_source")))
    names = [c for p in parts for c in p.columns if c not in (*keys, time, "_source")]
    wide = parts[0]
    for p in parts[1:]:
        wide = wide.unionByName(p, allowMissingColumns=True)
    made = wide.groupBy(*keys, time).agg(*[F.max(S.col(c)).alias(c) for c in names], F.greatest(F.lit(0), *[F.count_if(F.col("_source") == k) for k in range(len(parts))]).alias("_most"))
    twice = F.when(F.col("_most") > 1, F.raise_error(F.lit("a source has two rows of one time")))
    return made.where(F.coalesce(twice.cast("boolean"), F.lit(True))).drop("_most")


def forward_fill(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), time: str = TIME) -> DataFrame:
    """Each named column keeps its latest value that isn't null."""
    s = Series(keys, time)
    return df.select(*[(s.fill(c) if c in columns else S.col(c)).alias(c) for c in df.columns])


def _have(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def _add(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.withColumns(new) if new else df


def derive(df: DataFrame, keys: Sequence[str] = (), time: str = TIME, intervals: Sequence[str] = INTERVALS, extended: bool = False) -> DataFrame:
    """Derived features of each interval, where their inputs are there.

    ``extended`` first supplies inputs that silver does not hold (total volume, vwap, the
    best prices), and takes the net move instead of the path as the efficiency ratio's numerator.
    """
    s, c, out = Series(keys, time), S.col, df
    ln = lambda x: F.when(x > 0, F.ln(x))
    if extended:
        extra = {}
        for i in intervals:
            t = f"trades_{i}_"
            if _have(out, t + "volume_buy", t + "volume_sell") and not _have(out, t + "volume_total"):
                extra[t + "volume_total"] = c(t + "volume_buy") + c(t + "volume_sell")
            if _have(out, t + "turnover_buy", t + "turnover_sell", t + "volume_buy", t + "volume_sell") and not _have(out, t + "vwap"):
                extra[t + "vwap"] = F.try_divide(c(t + "turnover_buy") + c(t + "turnover_sell"), c(t + "volume_buy") + c(t + "volume_sell"))
        out = _add(out, extra)
    one: dict[str, Column] = {}  # first: all lags and rolling values of inputs
    for i in intervals:
        wmp, index = f"orderbook_{i}_wmp_last", f"index_price_{i}_close"
        if _have(out, wmp):
            one |= {f"_lag1_{i}": s.lag(wmp), f"_lag3_{i}": s.lag(wmp, 3), f"_lag12_{i}": s.lag(wmp, 12), f"_m12_{i}": s.roll(wmp, 12), f"_s12_{i}": s.roll(wmp, 12, "std"), f"_hi12_{i}": s.roll(wmp, 12, "max"), f"_lo12_{i}": s.roll(wmp, 12, "min")}
            one[f"_path_{i}"] = F.abs(c(wmp) - s.lag(wmp))
        if _have(out, index):
            one[f"_ilag1_{i}"] = s.lag(index)
        for name in ("spread_mean",):
            if _have(out, f"orderbook_{i}_{name}"):
                one |= {f"_sp_m_{i}": s.roll(f"orderbook_{i}_{name}", 12), f"_sp_s_{i}": s.roll(f"orderbook_{i}_{name}", 12, "std")}
        if _have(out, f"trades_{i}_volume_total"):
            one |= {f"_vol_m_{i}": s.roll(f"trades_{i}_volume_total", 12), f"_vol_s_{i}": s.roll(f"trades_{i}_volume_total", 12, "std")}
    if _have(out, "funding_funding_rate"):
        one["_fund12"] = s.roll("funding_funding_rate", 12)
    out = _add(out, one)
    two: dict[str, Column] = {}
    hour = F.pmod(F.floor(F.col(time) / 3_600_000), F.lit(24)).cast("double")
    two["feat_hour_sin"], two["feat_hour_cos"] = F.sin(F.lit(2 * math.pi) * hour / 24), F.cos(F.lit(2 * math.pi) * hour / 24)
    for i in intervals:
        ob, tr, ix, mk = f"orderbook_{i}_", f"trades_{i}_", f"index_price_{i}_", f"mark_price_{i}_"
        f = lambda name, i=i: f"feat_{name}_{i}"
        wmp = c(ob + "wmp_last")
        if _have(out, ob + "wmp_last"):
            two[f("log_return_trade")] = ln(S.ratio(wmp, c(f"_lag1_{i}")))
            two[f("price_velocity")] = (wmp - c(f"_lag3_{i}")) / 3
            two[f("ma_divergence")] = S.ratio(wmp, c(f"_m12_{i}")) - 1
            two[f("price_entropy")] = S.ratio(c(f"_s12_{i}"), c(f"_m12_{i}"))
            two[f"_sum12_{i}"] = s.roll(f"_path_{i}", 12, "sum")
            if _have(out, ob + "wmp_min", ob + "wmp_max"):
                two[f("rsi_proxy")] = S.ratio(wmp - c(ob + "wmp_min"), c(ob + "wmp_max") - c(ob + "wmp_min"))
            if _have(out, "funding_funding_rate"):
                two[f("funding_cost")] = c("funding_funding_rate") * wmp
        if _have(out, ix + "close"):
            two[f("log_return_index")] = ln(S.ratio(c(ix + "close"), c(f"_ilag1_{i}")))
        if _have(out, tr + "price_mean_trade", ix + "mean"):
            two[f("basis_spread")] = c(tr + "price_mean_trade") - c(ix + "mean")
            two[f("basis_ratio")] = S.ratio(c(tr + "price_mean_trade") - c(ix + "mean"), c(ix + "mean"))
        if _have(out, mk + "mean", ix + "mean"):
            two[f("premium_index")] = S.ratio(c(mk + "mean") - c(ix + "mean"), c(ix + "mean"))
        if _have(out, tr + "price_std_trade", ix + "std"):
            two[f("volatility_spread")] = c(tr + "price_std_trade") - c(ix + "std")
        if _have(out, "funding_funding_rate"):
            two[f("funding_trend")] = c("funding_funding_rate") - c("_fund12")
        if _have(out, ob + "spread_mean", ob + "wmp_mean"):
            two[f("rel_spread")] = S.ratio(c(ob + "spread_mean"), c(ob + "wmp_mean"))
        if _have(out, ob + "spread_mean"):
            two[f("z_spread")] = S.ratio(c(ob + "spread_mean") - c(f"_sp_m_{i}"), c(f"_sp_s_{i}"))
        if _have(out, tr + "price_max_trade", tr + "price_min_trade", tr + "price_mean_trade"):
            two[f("candle_range")] = S.ratio(c(tr + "price_max_trade") - c(tr + "price_min_trade"), c(tr + "price_mean_trade"))
            if _have(out, tr + "price_last_trade"):
                two[f("tail_extension")] = S.ratio(c(tr + "price_max_trade") - c(tr + "price_last_trade"), c(tr + "price_max_trade") - c(tr + "price_min_trade"))
        if _have(out, tr + "volume_total"):
            total = c(tr + "volume_total")
            two[f("trade_imbalance")] = S.ratio(c(tr + "volume_buy") - c(tr + "volume_sell"), total)
            two[f("aggressiveness")] = S.ratio(c(tr + "count_buy"), c(tr + "count_sell"))
            two[f("z_volume")] = S.ratio(total - c(f"_vol_m_{i}"), c(f"_vol_s_{i}"))
            for side, sums in (("buy", "ask"), ("sell", "bid")):
                if _have(out, ob + f"sum_{sums}_50"):
                    two[f(f"{side}_consumption")] = S.ratio(c(tr + f"volume_{side}"), c(ob + f"sum_{sums}_50"))
        if _have(out, ob + "sum_bid_50", ob + "sum_ask_50", ob + "total_depth_50"):
            two[f("depth_imbalance")] = S.ratio(c(ob + "sum_bid_50") - c(ob + "sum_ask_50"), c(ob + "total_depth_50"))
            if _have(out, ob + "sum_bid_5"):
                two[f("depth_convexity")] = S.ratio(c(ob + "sum_bid_5"), c(ob + "sum_bid_50"))
        if _have(out, ob + "total_depth_50", ob + "spread_mean"):
            two[f("liq_density")] = S.ratio(c(ob + "total_depth_50"), c(ob + "spread_mean"))
        if _have(out, ob + "sum_bid_20", ob + "best_bid", ob + "bid_px_20", ob + "sum_ask_20", ob + "best_ask", ob + "ask_px_20"):
            two[f("bid_slope")] = S.ratio(c(ob + "sum_bid_20"), c(ob + "best_bid") - c(ob + "bid_px_20"))
            two[f("ask_slope")] = S.ratio(c(ob + "sum_ask_20"), c(ob + "ask_px_20") - c(ob + "best_ask"))
        if _have(out, ob + "wmp_last", tr + "vwap"):
            two[f("dist_vwap")] = S.ratio(wmp - c(tr + "vwap"), c(tr + "vwap"))
            two[f("dist_max")] = S.ratio(wmp - c(f"_hi12_{i}"), c(f"_hi12_{i}"))
            two[f("dist_min")] = S.ratio(wmp - c(f"_lo12_{i}"), c(f"_lo12_{i}"))
    out = _add(out, two)
    three: dict[str, Column] = {}
    for i in intervals:
        f = lambda name, i=i: f"feat_{name}_{i}"
        if _have(out, f("log_return_trade"), f("log_return_index")):
            three[f("trend_divergence")] = c(f("log_return_trade")) - c(f("log_return_index"))
        if _have(out, f("basis_ratio"), "funding_funding_rate"):
            three[f("funding_basis_corr")] = c("funding_funding_rate") * c(f("basis_ratio"))
        if _have(out, f("price_velocity")):
            three[f("price_accel")] = c(f("price_velocity")) - s.lag(f("price_velocity"))
            path = c(f"_sum12_{i}")
            three[f("efficiency_ratio")] = S.ratio(F.abs(c(f"orderbook_{i}_wmp_last") - c(f"_lag12_{i}")) if extended else path, path)
        if _have(out, f("trade_imbalance"), f("depth_imbalance")):
            three[f("smart_money_div")] = c(f("trade_imbalance")) - c(f("depth_imbalance"))
        if _have(out, f("bid_slope"), f("ask_slope")):
            three[f("slope_imbalance")] = S.ratio(c(f("bid_slope")), c(f("ask_slope")))
        if _have(out, f("trade_imbalance")):
            three[f("z_imbalance")] = S.ratio(c(f("trade_imbalance")) - s.roll(f("trade_imbalance"), 12), s.roll(f("trade_imbalance"), 12, "std"))
    out = _add(out, three)
    return out.select(*[c(n) for n in out.columns if not n.startswith("_")])


#: Rows (of five minutes) by which features are lagged, and the names the lags carry.  Fixed values.
LAGS = {
    "5m": ((1, "5m"), (3, "15m"), (12, "1h"), (48, "4h"), (288, "1d")),
    "15m": ((1, "15m"), (4, "1h"), (16, "4h"), (48, "1d"), (288, "3d")),
    "1h": ((1, "1h"), (4, "4h"), (24, "1d"), (72, "3d"), (288, "12d")),
    "4h": ((1, "4h"), (6, "1d"), (18, "3d"), (72, "12d"), (144, "24d")),
    "1d": ((1, "1d"), (3, "3d"), (12, "12d"), (24, "24d"), (48, "48d")),
}
#: Features that are lagged, intervals that are compared, and features that are rolled.  Fixed values.
LAGGED = (
    "log_return_trade", "price_velocity", "ma_divergence", "rsi_proxy", "trade_imbalance", "smart_money_div", "buy_consumption", "sell_consumption",
    "depth_imbalance", "bid_slope", "ask_slope", "liq_density", "basis_ratio", "funding_trend", "log_return_index", "candle_range", "z_volume",
)
PAIRS = (("5m", "1h"), ("15m", "4h"), ("1h", "1d"))
ROLLED = ("log_return_trade", "trade_imbalance", "basis_ratio")


def lags(df: DataFrame, keys: Sequence[str] = (), time: str = TIME, intervals: Sequence[str] = INTERVALS) -> DataFrame:
    """Lags of features, what compares a feature with its lag or with a longer interval's, and rolling values of features."""
    s, c = Series(keys, time), S.col
    one: dict[str, Column] = {}
    for i in intervals:
        for b in LAGGED:
            if _have(df, f"feat_{b}_{i}"):
                one |= {f"feat_{b}_{i}_lag_{name}": s.lag(f"feat_{b}_{i}", k) for k, name in LAGS[i]}
    for i in (x for x in ("5m", "15m", "1h") if x in intervals):
        for b in ROLLED:
            n = f"feat_{b}_{i}"
            if _have(df, n):
                one |= {f"{n}_roll_mean_3p": s.roll(n, 3), f"{n}_roll_mean_6p": s.roll(n, 6), f"{n}_roll_std_3p": s.roll(n, 3, "std")}
    out = _add(df, one)
    two: dict[str, Column] = {}
    for i in intervals:
        (_, near), far = LAGS[i][0], LAGS[i][-2][1]
        r, rl = f"feat_log_return_trade_{i}", f"feat_log_return_trade_{i}_lag_{near}"
        if _have(out, r, rl):
            two |= {f"feat_momentum_persistence_{i}": c(r) * c(rl), f"feat_momentum_acceleration_{i}": c(r) - c(rl)}
        t, tl = f"feat_trade_imbalance_{i}", f"feat_trade_imbalance_{i}_lag_{near}"
        if _have(out, t, tl):
            two[f"feat_flow_persistence_{i}"] = c(t) * c(tl)
            two[f"feat_flow_reversal_bullish_{i}"] = ((c(t) > 0) & (c(tl) < 0)).cast("tinyint")
            two[f"feat_flow_reversal_bearish_{i}"] = ((c(t) < 0) & (c(tl) > 0)).cast("tinyint")
        b, bl = f"feat_basis_ratio_{i}", f"feat_basis_ratio_{i}_lag_{far}"
        if _have(out, b, bl):
            two[f"feat_basis_expansion_{i}"] = c(b) - c(bl)
        for x in ROLLED:
            n = f"feat_{x}_{i}"
            if _have(out, f"{n}_roll_mean_3p"):
                two[f"{n}_vs_trend_z"] = S.ratio(c(n) - c(f"{n}_roll_mean_3p"), c(f"{n}_roll_std_3p"))
    for a, b in PAIRS:
        if _have(out, f"feat_log_return_trade_{a}", f"feat_log_return_trade_{b}"):
            x, y = c(f"feat_log_return_trade_{a}"), c(f"feat_log_return_trade_{b}")
            two |= {f"feat_momentum_alignment_{a}_{b}": x * y, f"feat_momentum_divergence_{a}_{b}": x - y}
        if _have(out, f"feat_trade_imbalance_{a}", f"feat_trade_imbalance_{b}"):
            two[f"feat_flow_alignment_{a}_{b}"] = c(f"feat_trade_imbalance_{a}") * c(f"feat_trade_imbalance_{b}")
    return _add(out, two)


#: Returns that count as a rise.  Fixed values.
THRESHOLDS = {"5m": 0.0018, "15m": 0.004, "1h": 0.008, "4h": 0.015, "1d": 0.02}
#: Rows ahead and the names they carry.  Fixed values.
LEADS = {
    "5m": ((3, "15m"), (6, "30m"), (12, "60m")),
    "15m": ((4, "60m"), (8, "2h"), (16, "4h")),
    "1h": ((4, "4h"), (12, "12h"), (24, "24h")),
}
#: Returns that make the outer classes.  Fixed values.
CLASSES = {"5m": 0.001, "15m": 0.002, "1h": 0.005, "4h": 0.01, "1d": 0.02}


def labels(df: DataFrame, kinds: Sequence[str] = ("optimal",), keys: Sequence[str] = (), time: str = TIME, intervals: Sequence[str] = INTERVALS) -> DataFrame:
    """Forward-looking labels of the weighted mid price; the last rows, whose future isn't known, have null labels.

    optimal: 1 if the next return beats the interval's threshold.  simple: next price, return, its size, rise.
    multi: returns and rises over several leads.  cat: four classes by sign and size.  voladj: return over its
    rolling deviation, its sign, and whether it exceeds 1.
    """
    s, c = Series(keys, time), S.col
    now = {i: f"orderbook_{i}_wmp_last" for i in intervals if _have(df, f"orderbook_{i}_wmp_last")}
    rise = lambda i, k: S.ratio(s.lead(now[i], k) - c(now[i]), c(now[i]))
    out = _add(df, {f"_r_{i}": rise(i, 1) for i in now})
    new: dict[str, Column] = {}
    for i in now:
        r = c(f"_r_{i}")
        if "optimal" in kinds:
            new[f"label_{i}"] = (r > THRESHOLDS[i]).cast("tinyint")
        if "simple" in kinds:
            ahead = s.lead(now[i])
            new |= {f"{now[i]}_future_1p": ahead, f"return_{i}": r, f"return_abs_{i}": F.abs(r)}
            new.setdefault(f"label_{i}", (ahead > c(now[i])).cast("tinyint"))
        if "multi" in kinds:
            for k, name in LEADS.get(i, ()):
                new |= {f"return_{i}_{name}": rise(i, k), f"label_{i}_{name}": (s.lead(now[i], k) > c(now[i])).cast("tinyint")}
        if "cat" in kinds:
            big = CLASSES[i]
            # no return and a fall beyond the threshold are class 0; a small fall or no change 1; a small rise 2
            new[f"label_cat_{i}"] = F.when(r > big, 3).when(r > 0, 2).when(r >= -big, 1).otherwise(0).cast("tinyint")
    out = _add(out, new)
    if "voladj" in kinds:
        near = [i for i in now if i in ("5m", "15m", "1h")]
        out = _add(out, {f"vol_{i}_24p": s.roll(f"_r_{i}", 24, "std") for i in near})
        out = _add(out, {f"return_vol_adj_{i}": S.ratio(c(f"_r_{i}"), c(f"vol_{i}_24p")) for i in near})
        out = _add(out, {k: v for i in near for k, v in ((f"label_vol_adj_{i}", (c(f"return_vol_adj_{i}") > 0).cast("tinyint")), (f"label_strong_move_{i}", (F.abs(c(f"return_vol_adj_{i}")) > 1).cast("tinyint")))})
    return out.select(*[c(n) for n in out.columns if not n.startswith("_")])


def label_distribution(df: DataFrame) -> DataFrame:
    """label, rows, nulls, positive share for every label column, from one pass."""
    names = [n for n in df.columns if n.startswith("label_")]
    made = df.agg(*[F.struct(F.count(S.col(n)).alias("n"), F.count_if(S.col(n).isNull()).alias("nulls"), F.avg(S.col(n)).alias("share")).alias(n) for n in names])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("label"), S.col(n).alias("v")) for n in names]))
    return made.select(each.alias("e")).select("e.label", F.col("e.v.n").alias("n"), F.col("e.v.nulls").alias("nulls"), F.col("e.v.share").alias("share"))
