"""Silver trades: 91 metrics of each sliding window, as one aggregation.

Input columns: trade_id, side, price, size, created_time (epoch ms), and the key columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import STEP_MS, to_ms

from . import panes as P
from . import windows as W

POPULATIONS = ("trade", "buy", "sell")
QUANTILES = (0.25, 0.50, 0.75)
GROUPS = ("flow", "core", "quantiles", "moments", "nunique", "ticks", "rate", "corr")


def _is(pop: str) -> Column | None:
    return None if pop == "trade" else F.col("side") == pop


def prepare(trades: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds turnover (unless there), the previous row's time and price, and the time of the last buy and sell before.

    The previous row is looked up once over the whole series; inside a window it
    counts only if it lies in the window too, which is what a difference within
    the window's rows says.
    """
    t = F.col("created_time")
    before = {"_prev": F.struct(t.alias("t"), F.col("price").alias("p")), **{f"_prev_{s}": F.when(_is(s), t) for s in POPULATIONS[1:]}}
    got = W.with_previous(trades, "created_time", ["created_time", "trade_id"], before, keys)
    got = got if "turnover" in got.columns else got.withColumn("turnover", F.col("price") * F.col("size"))
    return got.withColumns({"_prev_t": F.col("_prev.t"), "_prev_p": F.col("_prev.p")}).drop("_prev")


def metrics(size: int, groups: Iterable[str] = GROUPS) -> list[Column]:
    """Aggregates of a window of ``size`` ms; rows come from prepare() and carry ``window_end``."""
    t, start = F.col("created_time"), F.col("window_end") - F.lit(size)
    order = F.struct("created_time", "trade_id")
    price, volume = F.col("price"), F.col("size")
    age = (F.col("window_end") - t).cast("double")
    out: list[Column] = []
    add = lambda name, x: out.append(x.alias(name))
    for g in groups:
        if g == "flow":
            for side in ("buy", "sell"):
                add(f"volume_{side}", S.total(volume, _is(side)))
                add(f"turnover_{side}", S.total(F.col("turnover"), _is(side)))
                add(f"count_{side}", S.rows(_is(side)))
            add("last_trade_time_ms", F.max(t))
            add("trade_count", S.rows())
        elif g == "core":
            for pop in POPULATIONS:
                w = _is(pop)
                add(f"price_first_{pop}", S.first_by(price, order, w))
                add(f"price_last_{pop}", S.last_by(price, order, w))
                for what, x in (("price", price), ("size", volume)):
                    add(f"{what}_mean_{pop}", F.avg(S.given(x, w)))
                    add(f"{what}_std_{pop}", F.stddev_samp(S.given(x, w)))
                    add(f"{what}_min_{pop}", F.min(S.given(x, w)))
                    add(f"{what}_max_{pop}", F.max(S.given(x, w)))
        elif g == "quantiles":
            for pop in POPULATIONS:
                for what, x in (("price", price), ("size", volume)):
                    for q in QUANTILES:
                        add(f"{what}_{q:.2f}_{pop}", S.quantile(x, q, _is(pop)))
        elif g == "moments":
            for pop in POPULATIONS:
                for what, x in (("price", price), ("size", volume)):
                    add(f"{what}_skew_{pop}", F.skewness(S.given(x, _is(pop))))
                    add(f"{what}_kurtosis_{pop}", F.kurtosis(S.given(x, _is(pop))))
        elif g == "nunique":
            for pop in POPULATIONS:
                add(f"nunique_price_{pop}", S.distinct(price, _is(pop)))
                add(f"nunique_size_{pop}", S.distinct(volume, _is(pop)))
        elif g == "ticks":
            inside = F.col("_prev_t") >= start
            add("count_tick_up", S.rows(inside & (price > F.col("_prev_p"))))
            add("count_tick_down", S.rows(inside & (price < F.col("_prev_p"))))
        elif g == "rate":
            for pop in POPULATIONS:
                prev = F.col("_prev_t" if pop == "trade" else f"_prev_{pop}")
                gap = F.when(prev >= start, (t - prev).cast("double"))
                gap = S.given(gap, _is(pop))
                for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min)):
                    add(f"rate_{name}_ms_{pop}", f(gap))
        elif g == "corr":
            # the correlation with (latest time - t) is that with (end - t): they differ by a constant
            add("corr_price_size_trade", S.corr(price, volume))
            add("corr_price_time_trade", S.corr(price, age))
            add("corr_size_time_trade", S.corr(volume, age))
        else:
            raise ValueError(f"unknown group {g!r}")
    return out


def recipe(size: int, step: int, groups: Iterable[str], only: Sequence[str] = ()) -> P.Recipe:
    """What metrics() says, for windows out of panes."""
    r = P.Recipe("created_time", size, step, only)
    order, side = F.struct("created_time", "trade_id"), F.col("side")
    price, volume = F.col("price"), F.col("size")
    other = ~F.coalesce(side.isin(*POPULATIONS[1:]), F.lit(False))

    def lists(what: str, x: Column, pop: str) -> dict[str, Column]:
        each = {f"{what}_buy": S.given(x, _is("buy")), f"{what}_sell": S.given(x, _is("sell")), f"{what}_other": S.given(x, other)}
        return each if pop == "trade" else {f"{what}_{pop}": each[f"{what}_{pop}"]}

    for g in groups:
        if g == "flow":
            for s in ("buy", "sell"):
                r.sum(f"volume_{s}", S.given(volume, _is(s)))
                r.sum(f"turnover_{s}", S.given(F.col("turnover"), _is(s)))
                r.rows(f"count_{s}", _is(s))
            r.high("last_trade_time_ms", F.col("created_time"))
            r.rows("trade_count")
        elif g in ("core", "moments"):
            for pop in POPULATIONS:
                if g == "core":
                    r.edge(f"price_first_{pop}", price, order, False, _is(pop))
                    r.edge(f"price_last_{pop}", price, order, True, _is(pop))
                for what, x in (("price", S.given(price, _is(pop))), ("size", S.given(volume, _is(pop)))):
                    if g == "core":
                        r.spread(f"{what}_{pop}", x, f"{what}_mean_{pop}", f"{what}_std_{pop}")
                        r.low(f"{what}_min_{pop}", x)
                        r.high(f"{what}_max_{pop}", x)
                    else:
                        r.spread(f"{what}_{pop}", x, None, None, f"{what}_skew_{pop}", f"{what}_kurtosis_{pop}")
        elif g == "quantiles":
            for pop in POPULATIONS:
                for what, x in (("price", price), ("size", volume)):
                    for q in QUANTILES:
                        r.value(f"{what}_{q:.2f}_{pop}", f"{what}_{pop}", lists(what, x, pop), lambda v, q=q: P.nth(v, q))
        elif g == "nunique":
            for pop in POPULATIONS:
                for what, x in (("price", price), ("size", volume)):
                    r.value(f"nunique_{what}_{pop}", f"{what}_{pop}", lists(what, x, pop), lambda v: F.size(F.array_distinct(v)).cast("long"), F.lit(0))
        elif g == "ticks":
            r.moved("count_tick_up", F.col("_prev_t"), price > F.col("_prev_p"))
            r.moved("count_tick_down", F.col("_prev_t"), price < F.col("_prev_p"))
        elif g == "rate":
            for pop in POPULATIONS:
                r.gaps(pop, f"_{pop}", F.col("_prev_t" if pop == "trade" else f"_prev_{pop}"), _is(pop))
        elif g == "corr":
            age = (F.col("_pane") - F.col("created_time")).cast("double")
            r.corr("corr_price_size_trade", price, volume)
            r.corr("corr_price_time_trade", price, age, age=True)
            r.corr("corr_size_time_trade", volume, age, age=True)
        else:
            raise ValueError(f"unknown group {g!r}")
    return r


def aggregate(trades: DataFrame, interval: str, groups: Iterable[str] = GROUPS, keys: Sequence[str] = (), step: int = STEP_MS, only: Sequence[str] = ()) -> DataFrame:
    """Keys, window_end (epoch ms) and the metrics of the chosen groups, or ``only`` some of them; empty windows have no row.

    Windows of several steps come from panes, so rows are not copied to each of their windows.
    """
    size = to_ms(interval)
    groups = list(groups)
    ready = prepare(trades, keys) if {"ticks", "rate"} & set(groups) else trades if "turnover" in trades.columns else trades.withColumn("turnover", F.col("price") * F.col("size"))
    ready = ready.where(F.col("created_time").isNotNull())
    if P.suits(size, step):
        return P.combine(ready, recipe(size, step, groups, only), keys)
    spread = W.spread(ready, "created_time", size, step)
    spread = spread if W.in_own_day(size, step) else W.on_source_days(spread, W.source_days(trades, "created_time", keys), keys)
    got = spread.groupBy(*keys, "window_end").agg(*metrics(size, groups))
    return got.select(*keys, "window_end", *[S.col(n) for n in only]) if only else got


def aggregate_panes(trades: DataFrame, interval: str, keys: Sequence[str] = (), step: int = STEP_MS) -> DataFrame:
    """What aggregate() gives for the groups flow and core, from panes: each trade is read once, however long the window.

    A pane keeps counts, means and variances; windows add them up as deviations from the
    series' centre, so that large prices don't cancel.
    """
    size = to_ms(interval)
    full = trades if "turnover" in trades.columns else trades.withColumn("turnover", F.col("price") * F.col("size"))
    order = F.struct("created_time", "trade_id")
    aggs: list[Column] = [F.max("created_time").alias("_last"), F.count(F.lit(1)).alias("_n")]
    for pop in POPULATIONS:
        w = _is(pop)
        if pop != "trade":
            aggs += [S.total(F.col("size"), w).alias(f"volume_{pop}"), S.total(F.col("turnover"), w).alias(f"turnover_{pop}"), S.rows(w).alias(f"count_{pop}")]
        aggs += [F.min(S.given(F.struct("created_time", "trade_id", "price"), w)).alias(f"_first_{pop}"), F.max(S.given(F.struct("created_time", "trade_id", "price"), w)).alias(f"_last_{pop}")]
        for x in ("price", "size"):
            v = S.given(F.col(x), w)
            aggs += [F.count(v).alias(f"_n_{x}_{pop}"), F.sum(v).alias(f"_s_{x}_{pop}"), F.avg(v).alias(f"_m_{x}_{pop}"), F.var_pop(v).alias(f"_v_{x}_{pop}"), F.min(v).alias(f"_lo_{x}_{pop}"), F.max(v).alias(f"_hi_{x}_{pop}")]
    panes = full.withColumn("window_end", W.pane_of(F.col("created_time"), step)).groupBy(*keys, "window_end").agg(*aggs)
    days = W.source_days(trades, "created_time", keys)
    grid = W.window_grid(days, keys, step).join(panes, [*keys, "window_end"], "full_outer")
    whole = Window.partitionBy(*keys)
    grid = grid.withColumns({f"_c_{x}_{pop}": F.avg(f"_m_{x}_{pop}").over(whole) for pop in POPULATIONS for x in ("price", "size")})
    f = W.over_panes(size, keys, step)
    out = [F.col("window_end"), *[F.col(k) for k in keys]]
    get = lambda c: F.col(c)
    for side in ("buy", "sell"):
        out += [F.coalesce(F.sum(get(f"{m}_{side}")).over(f), F.lit(z)).alias(f"{m}_{side}") for m, z in (("volume", 0.0), ("turnover", 0.0), ("count", 0))]
    out += [F.max("_last").over(f).alias("last_trade_time_ms"), F.coalesce(F.sum("_n").over(f), F.lit(0)).alias("trade_count")]
    second: list[Column] = []
    for pop in POPULATIONS:
        out += [F.min(f"_first_{pop}").over(f)["price"].alias(f"price_first_{pop}"), F.max(f"_last_{pop}").over(f)["price"].alias(f"price_last_{pop}")]
        for x in ("price", "size"):
            p = f"{x}_{pop}"
            n, s = F.sum(f"_n_{p}").over(f), F.sum(f"_s_{p}").over(f)
            out += [n.alias(f"_n_{p}"), F.try_divide(s, n).alias(f"{x}_mean_{pop}"), F.min(f"_lo_{p}").over(f).alias(f"{x}_min_{pop}"), F.max(f"_hi_{p}").over(f).alias(f"{x}_max_{pop}")]
            d = F.col(f"_m_{p}") - F.col(f"_c_{p}")
            one, two = F.sum(F.col(f"_n_{p}") * d).over(f), F.sum(F.col(f"_n_{p}") * (F.col(f"_v_{p}") + d * d)).over(f)
            out += [one.alias(f"_one_{p}"), two.alias(f"_two_{p}")]
            n2 = F.col(f"_n_{p}")
            var = F.greatest((F.col(f"_two_{p}") - F.col(f"_one_{p}") * F.col(f"_one_{p}") / n2) / (n2 - 1), F.lit(0.0))
            still = F.col(f"{x}_min_{pop}") == F.col(f"{x}_max_{pop}")
            second.append(F.when(n2 > 1, F.when(still, F.lit(0.0)).otherwise(F.sqrt(var))).alias(f"{x}_std_{pop}"))
    combined = grid.select(*out)
    plain = [S.col(c) for c in combined.columns if not c.startswith("_")]
    got = combined.where("trade_count > 0").select(*plain, *second)
    return W.on_source_days(got, days, keys)
