"""Order books: features of each snapshot, and 77 metrics of each sliding window.

Input columns: ts (epoch ms), action, asks, bids; a side is JSON text, a list of
levels ["price", "quantity", ...] with the best level first.  Where there is a column seq, the row of
the least seq counts among those of one time, as the first and as the last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import STEP_MS, to_ms

from . import panes as P
from . import windows as W

LEVELS = 50
QUANTILES = (0.25, 0.50, 0.75)
FEATURES = ("weighted_mid_price", "spread", "deep_imbalance", "book_pressure", "total_depth_50", "concentration", "impact_slope_ask", "impact_slope_bid")


def _levels(side: str) -> Column:
    """array<struct<p, q>> of the first levels, as doubles; a value that is no number is null."""
    raw = F.slice(F.from_json(F.col(side), "array<array<string>>"), 1, LEVELS)
    return F.transform(raw, lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("p"), F.get(x, F.lit(1)).try_cast("double").alias("q")))


def _sum(levels: str, n: int, money: bool = False) -> Column:
    part = F.slice(F.col(levels), 1, n)
    one = (lambda x: x["p"] * x["q"]) if money else (lambda x: x["q"])
    return F.aggregate(part, F.lit(0.0), lambda acc, x: acc + F.coalesce(one(x), F.lit(0.0)))


def features(book: DataFrame) -> DataFrame:
    """One row for each snapshot with both sides: ts, the kernel's features and the depth sums they come from."""
    rows = book.where(F.col("action") == "snapshot") if "action" in book.columns else book
    keep = [c for c in rows.columns if c not in ("asks", "bids", "action")]
    rows = rows.select(*keep, _levels("asks").alias("_a"), _levels("bids").alias("_b")).where((F.size("_a") > 0) & (F.size("_b") > 0))

    def level(side: str, k: int) -> Column:
        return F.get(F.col(side), F.lit(k))["p"]

    base = {"best_bid": level("_b", 0), "best_ask": level("_a", 0)}
    for n in (5, 20, 50):
        base |= {f"sum_bid_{n}": _sum("_b", n), f"sum_ask_{n}": _sum("_a", n)}
    base |= {"bid_px_20": F.coalesce(level("_b", 19), level("_b", 0)), "ask_px_20": F.coalesce(level("_a", 19), level("_a", 0))}
    base |= {"total_money_bid_50": _sum("_b", 50, True), "total_money_ask_50": _sum("_a", 50, True)}
    one = rows.select(*keep, *[x.alias(n) for n, x in base.items()])
    c = F.col
    one = one.withColumns({"total_money_50": c("total_money_bid_50") + c("total_money_ask_50"), "total_depth_50": c("sum_bid_50") + c("sum_ask_50"), "spread": c("best_ask") - c("best_bid")})
    one = one.withColumns(
        {
            "weighted_mid_price": S.ratio(c("total_money_50"), c("total_depth_50")),
            "deep_imbalance": S.ratio(c("sum_bid_50"), c("total_depth_50")),
            "concentration": S.ratio(c("sum_bid_5") + c("sum_ask_5"), c("total_depth_50")),
            "impact_slope_ask": S.ratio(c("ask_px_20") - c("best_ask"), c("sum_ask_20")),
            "impact_slope_bid": S.ratio(c("best_bid") - c("bid_px_20"), c("sum_bid_20")),
        }
    )
    return one.withColumn("book_pressure", c("weighted_mid_price") - (c("best_ask") + c("best_bid")) / 2)


def metrics(size: int) -> list[Column]:
    """Window aggregates over features(); rows carry ``window_end``, ``_prev_t``, ``_first`` and ``_last`` (by what rows are ordered)."""
    out: list[Column] = []
    add = lambda name, x: out.append(x.alias(name))

    def block(short: str, x: Column, names: Sequence[str]) -> None:
        f = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": S.total, "skew": F.skewness, "kurtosis": F.kurtosis}
        for n in names:
            if n in f:
                add(f"{short}_{n}", f[n](x))
            elif n in ("first", "last"):
                add(f"{short}_{n}", F.min_by(x, F.col("_first")) if n == "first" else F.max_by(x, F.col("_last")))
            else:
                add(f"{short}_{n}", S.quantile(x, float(n)))

    eleven = ("first", "last", "mean", "std", "min", "max", "0.25", "0.50", "0.75", "skew", "kurtosis")
    four = ("mean", "std", "min", "max")
    c = F.col
    for short, x in (("wmp", "weighted_mid_price"), ("spread", "spread"), ("imbal", "deep_imbalance")):
        block(short, c(x), eleven)
    block("pressure", c("book_pressure"), (*eleven, "sum"))
    block("depth", c("total_depth_50"), (*four, "first", "last"))
    for short, x in (("conc", "concentration"), ("impact_ask", "impact_slope_ask"), ("impact_bid", "impact_slope_bid")):
        block(short, c(x), four)
    add("snapshot_count", S.rows())
    gap = F.when(c("_prev_t") >= c("window_end") - F.lit(size), (c("ts") - c("_prev_t")).cast("double"))
    for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min)):
        add(f"rate_{n}_ms", f(gap))
    age = (c("window_end") - c("ts")).cast("double")
    short = {"wmp": c("weighted_mid_price"), "spread": c("spread"), "imbal": c("deep_imbalance"), "pressure": c("book_pressure"), "depth": c("total_depth_50"), "conc": c("concentration"), "time": age}
    short["impact"] = (c("impact_slope_ask") + c("impact_slope_bid")) / 2
    for a, b in CORRELATIONS:
        add(f"corr_{a}_{b}", S.corr(short[a], short[b]))
    add("last_update_time_ms", F.max("ts"))
    return out


CORRELATIONS = (("wmp", "imbal"), ("wmp", "depth"), ("wmp", "pressure"), ("wmp", "time"), ("spread", "imbal"), ("spread", "impact"), ("conc", "time"), ("pressure", "time"))


def recipe(size: int, step: int, only: Sequence[str] = ()) -> P.Recipe:
    """What metrics() says, for windows out of panes."""
    r, c = P.Recipe("ts", size, step, only), F.col
    eleven = (("wmp", "weighted_mid_price"), ("spread", "spread"), ("imbal", "deep_imbalance"), ("pressure", "book_pressure"))
    four = (("depth", "total_depth_50"), ("conc", "concentration"), ("impact_ask", "impact_slope_ask"), ("impact_bid", "impact_slope_bid"))
    for short, x in (*eleven, *four):
        high = [f"{short}_skew", f"{short}_kurtosis"] if (short, x) in eleven else []
        if high or short == "depth":
            r.edge(f"{short}_first", c(x), c("_first"), False)
            r.edge(f"{short}_last", c(x), c("_last"), True)
        r.spread(short, c(x), f"{short}_mean", f"{short}_std", *high)
        r.low(f"{short}_min", c(x))
        r.high(f"{short}_max", c(x))
        for q in QUANTILES if high else ():
            r.value(f"{short}_{q:.2f}", short, {short: c(x)}, lambda v, q=q: P.nth(v, q))
    r.sum("pressure_sum", c("book_pressure"))
    r.rows("snapshot_count")
    r.gaps("all", "", c("_prev_t"))
    short = dict((*eleven, *four)) | {"impact": None, "time": None}
    age, impact = (c("_pane") - c("ts")).cast("double"), (c("impact_slope_ask") + c("impact_slope_bid")) / 2
    for a, b in CORRELATIONS:
        r.corr(f"corr_{a}_{b}", c(short[a]), age if b == "time" else impact if b == "impact" else c(short[b]), age=b == "time")
    r.high("last_update_time_ms", c("ts"))
    return r


def aggregate(book: DataFrame, interval: str, keys: Sequence[str] = (), step: int = STEP_MS, only: Sequence[str] = (), lasts: Sequence[str] = ()) -> DataFrame:
    """Keys, window_end and 77 metrics; from raw snapshots or from rows of features().

    ``only`` names the metrics that are wanted (then the others are not worked out), ``lasts`` feature columns whose
    last value in the window is wanted too.  Windows of several steps come from panes.  A column _prev_t, the time of
    the snapshot before, is taken as it is; rows without it are ordered here, with all their features.
    """
    size = to_ms(interval)
    rows = (book if "weighted_mid_price" in book.columns else features(book)).where(F.col("ts").isNotNull())
    tied = "seq" in rows.columns
    names = list(only) or list(recipe(size, step).out)
    before = ["ts", *(["seq"] if tied else [])]
    if "_prev_t" not in rows.columns:
        rows = W.with_previous(rows, "ts", before, {"_prev_t": F.col("ts")}, keys) if any(n.startswith("rate_") for n in names) else rows.withColumn("_prev_t", F.lit(None).cast("long"))
    rows = rows.withColumns({"_first": F.struct("ts", "seq") if tied else F.col("ts"), "_last": F.struct("ts", -F.col("seq")) if tied else F.col("ts")})
    if P.suits(size, step):
        r = recipe(size, step, [*names, *lasts])
        for n in lasts:
            r.edge(n, F.col(n), F.col("_last"), True)
        return P.combine(rows, r, keys)
    spread = W.spread(rows, "ts", size, step)
    spread = spread if W.in_own_day(size, step) else W.on_source_days(spread, W.source_days(rows, "ts", keys), keys)
    return spread.groupBy(*keys, "window_end").agg(*metrics(size), *[F.max_by(n, "_last").alias(n) for n in lasts]).select(*keys, "window_end", *[S.col(n) for n in (*names, *lasts)])
