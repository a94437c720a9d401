"""DuckDB SQL for the engine's queries, written for itself: joins where the engine unites, lists where it folds."""

from __future__ import annotations

from collections.abc import Sequence

S = 300_000
DAY = 86_400_000
SIZES = {"5m": 300_000, "15m": 900_000, "1h": 3_600_000, "4h": 14_400_000, "1d": 86_400_000}


def r(x: str) -> str:
    """Six decimals; the shift keeps decimal ties at the seventh from falling either way."""
    return f"round({x} + 2.3456789e-8::DOUBLE, 6) + 0.0"


def div(a: str, b: str) -> str:
    """The guarded quotient; null where the divisor is 0."""
    return f"({a}) / nullif(({b}) + 1e-9, 0)"


TRADES = """trades AS (
  SELECT event_id AS trade_id, CASE WHEN event_type IN ('click', 'purchase') THEN 'buy' WHEN event_type IN ('view', 'signup') THEN 'sell' ELSE 'other' END AS side,
    value AS price, CAST(regexp_extract(props, '([0-9.]+)', 1) AS DOUBLE) AS size, (epoch_us(ts) // 1000) AS created_time FROM events)"""

BOOK = """levels AS (
  SELECT (epoch_us(ts) // 1000) AS ts,
    list_transform(range(0, 50), lambda i: 1000.0::DOUBLE + value - 0.1::DOUBLE * (i + 1)) AS bp,
    list_transform(range(0, 50), lambda i: CAST(1 + (event_id * 7 + i * 3) % 11 AS DOUBLE)) AS bq,
    list_transform(range(0, 50), lambda i: 1000.0::DOUBLE + value + 0.1::DOUBLE * (i + 1) + 0.05::DOUBLE * (event_id % 7)) AS ap,
    list_transform(range(0, 50), lambda i: CAST(1 + (event_id * 5 + i * 2) % 13 AS DOUBLE)) AS aq
  FROM events WHERE event_type <> 'error'),
sums AS (
  SELECT ts, bp[1] AS best_bid, ap[1] AS best_ask, bp[20] AS bid_px_20, ap[20] AS ask_px_20,
    list_sum(bq[1:5]) AS sum_bid_5, list_sum(bq[1:20]) AS sum_bid_20, list_sum(bq) AS sum_bid_50,
    list_sum(aq[1:5]) AS sum_ask_5, list_sum(aq[1:20]) AS sum_ask_20, list_sum(aq) AS sum_ask_50,
    list_sum(list_transform(range(1, 51), lambda i: bp[i] * bq[i])) AS total_money_bid_50,
    list_sum(list_transform(range(1, 51), lambda i: ap[i] * aq[i])) AS total_money_ask_50
  FROM levels),
kernel AS (
  SELECT *, total_money_bid_50 + total_money_ask_50 AS total_money_50, sum_bid_50 + sum_ask_50 AS total_depth_50, best_ask - best_bid AS spread,
    (total_money_bid_50 + total_money_ask_50) / (sum_bid_50 + sum_ask_50 + 1e-9) AS weighted_mid_price,
    sum_bid_50 / (sum_bid_50 + sum_ask_50 + 1e-9) AS deep_imbalance,
    (sum_bid_5 + sum_ask_5) / (sum_bid_50 + sum_ask_50 + 1e-9) AS concentration,
    (ask_px_20 - best_ask) / (sum_ask_20 + 1e-9) AS impact_slope_ask,
    (best_bid - bid_px_20) / (sum_bid_20 + 1e-9) AS impact_slope_bid,
    (total_money_bid_50 + total_money_ask_50) / (sum_bid_50 + sum_ask_50 + 1e-9) - (best_ask + best_bid) / 2 AS book_pressure
  FROM sums),
book AS (SELECT ts, round(COLUMNS(* EXCLUDE ts), 9) FROM kernel)"""

KERNEL = (
    "best_bid", "best_ask", "sum_bid_5", "sum_ask_5", "sum_bid_20", "sum_ask_20", "sum_bid_50", "sum_ask_50", "bid_px_20", "ask_px_20", "total_money_bid_50", "total_money_ask_50",
    "total_money_50", "total_depth_50", "spread", "weighted_mid_price", "deep_imbalance", "concentration", "impact_slope_ask", "impact_slope_bid", "book_pressure",
)


def windows(source: str, time: str, interval: str, name: str, days: str | None = None) -> str:
    """CTEs: name_d (days with rows), name (a row for each window that a row lies in)."""
    size, days = SIZES[interval], days or time
    return f"""{name}_d AS (SELECT DISTINCT {days} // {DAY} AS d FROM {source}),
{name} AS (SELECT * FROM (SELECT *, unnest(generate_series(({time} // {S} + 1) * {S}, ({time} // {S} + 1) * {S} + {size - S}, {S})) AS window_end FROM {source}) WHERE (window_end - 1) // {DAY} IN (SELECT d FROM {name}_d))"""


def _f(pop: str) -> str:
    return "" if pop == "trade" else f" FILTER (WHERE side = '{pop}')"


def moments(x: str, pop: str, label: str) -> list[tuple[str, str]]:
    """List and mean that the outer query takes skewness and kurtosis from."""
    return [(f"l_{label}", f"list({x}){_f(pop)}"), (f"m_{label}", f"avg({x}){_f(pop)}")]


def _power(label: str, k: int) -> str:
    return f"list_sum(list_transform(l_{label}, lambda v: pow(v - m_{label}, {k})))"


def skew(label: str) -> str:
    return f"CASE WHEN {_power(label, 2)} > 0 THEN sqrt(len(l_{label})) * {_power(label, 3)} / pow({_power(label, 2)}, 1.5) END"


def kurt(label: str) -> str:
    return f"CASE WHEN {_power(label, 2)} > 0 THEN len(l_{label}) * {_power(label, 4)} / pow({_power(label, 2)}, 2) - 3 END"


def corr(a: str, b: str) -> str:
    return f"covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)"


def nearest(x: str, q: float, pop: str = "trade") -> str:
    f = _f(pop)
    return f"list_sort(list({x}){f})[CAST(round((count({x}){f} - 1) * {q}) AS INT) + 1]"


POPS = ("trade", "buy", "sell")


def trade_columns(group: str, interval: str) -> tuple[list[str], list[str]]:
    """(aggregates, outer columns) of a metric group."""
    size, out, outer = SIZES[interval], [], []

    def add(x: str, name: str, is_float: bool = True) -> None:
        out.append(f'{x} AS "{name}"')
        outer.append(f'{r(chr(34) + name + chr(34))} AS "{name}"' if is_float else f'"{name}"')

    if group == "flow":
        for s in ("buy", "sell"):
            add(f"coalesce(sum(size){_f(s)}, 0.0)", f"volume_{s}")
            add(f"coalesce(sum(price * size){_f(s)}, 0.0)", f"turnover_{s}")
            add(f"count(*){_f(s)}", f"count_{s}", False)
        add("max(created_time)", "last_trade_time_ms", False)
        add("count(*)", "trade_count", False)
    if group == "core":
        for p in POPS:
            add(f"arg_min(price, CAST(created_time AS HUGEINT) * 100000000 + trade_id){_f(p)}", f"price_first_{p}")
            add(f"arg_max(price, CAST(created_time AS HUGEINT) * 100000000 + trade_id){_f(p)}", f"price_last_{p}")
            for x in ("price", "size"):
                for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
                    add(f"{fn}({x}){_f(p)}", f"{x}_{n}_{p}")
    if group == "quantiles":
        for p in POPS:
            for x in ("price", "size"):
                for q in (0.25, 0.5, 0.75):
                    add(nearest(x, q, p), f"{x}_{q:.2f}_{p}")
    if group == "moments":
        for p in POPS:
            for x in ("price", "size"):
                label = f"{x}_{p}"
                out.extend(f"{e} AS {n}" for n, e in moments(x, p, label))
                outer.append(f"{r(skew(label))} AS {x}_skew_{p}")
                outer.append(f"{r(kurt(label))} AS {x}_kurtosis_{p}")
    if group == "nunique":
        for p in POPS:
            add(f"count(DISTINCT price){_f(p)}", f"nunique_price_{p}", False)
            add(f"count(DISTINCT size){_f(p)}", f"nunique_size_{p}", False)
    if group == "ticks":
        for n, op in (("up", ">"), ("down", "<")):
            add(f"count(*) FILTER (WHERE price {op} prev_p)", f"count_tick_{n}", False)
    if group == "rate":
        for p in POPS:
            gap = "created_time - prev_t" if p == "trade" else "created_time - prev_side_t"
            for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min")):
                add(f"{fn}(CAST({gap} AS DOUBLE)){_f(p)}", f"rate_{n}_ms_{p}")
    if group == "corr":
        age = "CAST(window_end - created_time AS DOUBLE)"
        for n, a, b in (("price_size", "price", "size"), ("price_time", "price", age), ("size_time", "size", age)):
            add(corr(a, b), f"corr_{n}_trade")
    del size
    return out, outer


def trade_windows(interval: str, groups: Sequence[str]) -> str:
    inner, outer = [], []
    for g in groups:
        a, b = trade_columns(g, interval)
        inner += a
        outer += b
    # neighbours inside each window, found window by window
    source = "w"
    lagged = ""
    if {"ticks", "rate"} & set(groups):
        lagged = """, l AS (SELECT *, lag(created_time) OVER e AS prev_t, lag(price) OVER e AS prev_p, lag(created_time) OVER s AS prev_side_t FROM w
  WINDOW e AS (PARTITION BY window_end ORDER BY created_time, trade_id), s AS (PARTITION BY window_end, side ORDER BY created_time, trade_id))"""
        source = "l"
    return f"""WITH {TRADES}, {windows('trades', 'created_time', interval, 'w')}{lagged},
a AS (SELECT window_end, {', '.join(inner)} FROM {source} GROUP BY window_end)
SELECT window_end, {', '.join(outer)} FROM a"""


CORRELATIONS = (("wmp", "imbal"), ("wmp", "depth"), ("wmp", "pressure"), ("wmp", "time"), ("spread", "imbal"), ("spread", "impact"), ("conc", "time"), ("pressure", "time"))


def book_windows(interval: str) -> str:
    inner, outer = [], []

    def add(x: str, name: str, is_float: bool = True) -> None:
        inner.append(f'{x} AS "{name}"')
        outer.append(f'{r(chr(34) + name + chr(34))} AS "{name}"' if is_float else f'"{name}"')

    def block(short: str, x: str, names: Sequence[str]) -> None:
        for n in names:
            if n in ("first", "last"):
                add(f"{'arg_min' if n == 'first' else 'arg_max'}({x}, ts)", f"{short}_{n}")
            elif n in ("skew", "kurtosis"):
                if n == "skew":
                    inner.extend(f"{e} AS {a}" for a, e in moments(x, "trade", short))
                outer.append(f"{r((skew if n == 'skew' else kurt)(short))} AS {short}_{n}")
            elif n[0] == "0":
                add(nearest(x, float(n)), f"{short}_{n}")
            else:
                add(f"{ {'mean': 'avg', 'std': 'stddev_samp', 'min': 'min', 'max': 'max', 'sum': 'sum'}[n]}({x})", f"{short}_{n}")

    eleven, four = ("first", "last", "mean", "std", "min", "max", "0.25", "0.50", "0.75", "skew", "kurtosis"), ("mean", "std", "min", "max")
    for short, x in (("wmp", "weighted_mid_price"), ("spread", "spread"), ("imbal", "deep_imbalance")):
        block(short, x, eleven)
    block("pressure", "book_pressure", (*eleven, "sum"))
    block("depth", "total_depth_50", (*four, "first", "last"))
    for short, x in (("conc", "concentration"), ("impact_ask", "impact_slope_ask"), ("impact_bid", "impact_slope_bid")):
        block(short, x, four)
    add("count(*)", "snapshot_count", False)
    for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min")):
        add(f"{fn}(CAST(ts - prev_t AS DOUBLE))", f"rate_{n}_ms")
    short = {"wmp": "weighted_mid_price", "spread": "spread", "imbal": "deep_imbalance", "pressure": "book_pressure", "depth": "total_depth_50", "conc": "concentration"}
    short |= {"time": "CAST(window_end - ts AS DOUBLE)", "impact": "(impact_slope_ask + impact_slope_bid) / 2"}
    for a, b in CORRELATIONS:
        add(corr(short[a], short[b]), f"corr_{a}_{b}")
    add("max(ts)", "last_update_time_ms", False)
    return f"""WITH {BOOK}, {windows('book', 'ts', interval, 'w')},
l AS (SELECT *, lag(ts) OVER (PARTITION BY window_end ORDER BY ts) AS prev_t FROM w),
a AS (SELECT window_end, {', '.join(inner)} FROM l GROUP BY window_end)
SELECT window_end, {', '.join(outer)} FROM a"""


def kline_feed(name: str, where: str = "true") -> str:
    return f"""{name} AS (SELECT (epoch_us(ts) // 1000) // 60000 * 60000 AS open_time, arg_min(value, CAST((epoch_us(ts) // 1000) AS HUGEINT) * 100000000 + event_id) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, CAST((epoch_us(ts) // 1000) AS HUGEINT) * 100000000 + event_id) AS close, (epoch_us(min(ts)) // 1000) // 60000 * 60000 + 60000 AS close_time FROM events WHERE {where} GROUP BY 1)"""


def kline_windows(feed: str, interval: str, name: str) -> str:
    return f"""{windows(feed, 'close_time', interval, name + '_w', 'open_time')},
{name} AS (SELECT window_end, arg_min(open, close_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, close_time) AS close, avg(close) AS mean, stddev_samp(close) AS std FROM {name}_w GROUP BY window_end)"""


INDEX, MARK = kline_feed("idx"), kline_feed("mrk", "event_type <> 'error'")
FUNDING = "funding AS (SELECT (epoch_us(ts) // 1000) // 28800000 * 28800000 AS funding_time, avg(value) / 10000 AS funding_rate FROM events GROUP BY 1)"


def gold(intervals: Sequence[str] = ("5m", "15m"), depth: bool = False, fill: bool = True) -> str:
    """CTEs up to ``g``: all sources joined on window_end, one full join after another."""
    ctes, joins = [TRADES, BOOK, INDEX, MARK, FUNDING], []
    for i in intervals:
        t = f"{i}"
        last = ", " + ", ".join(f"arg_max({n}, ts) AS orderbook_{i}_{n}" for n in ("sum_bid_5", "sum_bid_20", "sum_bid_50", "sum_ask_20", "sum_ask_50", "best_bid", "best_ask", "bid_px_20", "ask_px_20", "total_depth_50")) if depth else ""
        ctes += [
            windows("book", "ts", i, f"bw{t}"),
            f"ob{t} AS (SELECT window_end, arg_max(weighted_mid_price, ts) AS orderbook_{i}_wmp_last, min(weighted_mid_price) AS orderbook_{i}_wmp_min, max(weighted_mid_price) AS orderbook_{i}_wmp_max, avg(weighted_mid_price) AS orderbook_{i}_wmp_mean, avg(spread) AS orderbook_{i}_spread_mean{last} FROM bw{t} GROUP BY window_end)",
            windows("trades", "created_time", i, f"tw{t}"),
            f"tr{t} AS (SELECT window_end, avg(price) AS trades_{i}_price_mean_trade, stddev_samp(price) AS trades_{i}_price_std_trade, min(price) AS trades_{i}_price_min_trade, max(price) AS trades_{i}_price_max_trade, arg_max(price, CAST(created_time AS HUGEINT) * 100000000 + trade_id) AS trades_{i}_price_last_trade, "
            + ", ".join(f"coalesce(sum(size){_f(s)}, 0.0) AS trades_{i}_volume_{s}, coalesce(sum(price * size){_f(s)}, 0.0) AS trades_{i}_turnover_{s}, count(*){_f(s)} AS trades_{i}_count_{s}" for s in ("buy", "sell"))
            + f" FROM tw{t} GROUP BY window_end)",
            kline_windows("idx", i, f"ix{t}a"),
            f"ix{t} AS (SELECT window_end, close AS index_price_{i}_close, mean AS index_price_{i}_mean, std AS index_price_{i}_std FROM ix{t}a)",
            kline_windows("mrk", i, f"mk{t}a"),
            f"mk{t} AS (SELECT window_end, mean AS mark_price_{i}_mean FROM mk{t}a)",
        ]
        joins += [f"ob{t}", f"tr{t}", f"ix{t}", f"mk{t}"]
    ctes.append("fu AS (SELECT funding_time AS window_end, funding_rate AS funding_funding_rate, funding_time AS funding_funding_time FROM funding)")
    joins.append("fu")
    ctes.append(f"g0 AS (SELECT * FROM {joins[0]} " + " ".join(f"FULL JOIN {j} USING (window_end)" for j in joins[1:]) + ")")
    if fill:
        ctes.append("g AS (SELECT * REPLACE (last_value(funding_funding_rate IGNORE NULLS) OVER f AS funding_funding_rate, last_value(funding_funding_time IGNORE NULLS) OVER f AS funding_funding_time) FROM g0 WINDOW f AS (ORDER BY window_end ROWS UNBOUNDED PRECEDING))")
    else:
        ctes.append("g AS (SELECT * FROM g0)")
    return "WITH " + ",\n".join(ctes)


O = "OVER (ORDER BY window_end)"


def lag(c: str, k: int = 1) -> str:
    return f"lag({c}, {k}) {O}"


def roll(c: str, n: int, fn: str = "avg") -> str:
    f = f"OVER (ORDER BY window_end ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({c}) {f} = {n} THEN {fn}({c}) {f} END"


def ln(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln({x}) END"


def feature_sql(name: str, i: str) -> str:
    """A derived feature over ``g``; those over other features over ``d``."""
    w, ix, mk = f"orderbook_{i}_wmp_last", f"index_price_{i}_", f"mark_price_{i}_"
    t, ob = f"trades_{i}_", f"orderbook_{i}_"
    total = f"({t}volume_buy + {t}volume_sell)"
    vwap = f"(({t}turnover_buy + {t}turnover_sell) / nullif({t}volume_buy + {t}volume_sell, 0))"
    return {
        "log_return_trade": ln(div(w, lag(w))),
        "log_return_index": ln(div(ix + "close", lag(ix + "close"))),
        "basis_spread": f"{t}price_mean_trade - {ix}mean",
        "basis_ratio": div(f"{t}price_mean_trade - {ix}mean", ix + "mean"),
        "premium_index": div(f"{mk}mean - {ix}mean", ix + "mean"),
        "volatility_spread": f"{t}price_std_trade - {ix}std",
        "funding_cost": f"funding_funding_rate * {w}",
        "funding_trend": f"funding_funding_rate - ({roll('funding_funding_rate', 12)})",
        "price_velocity": f"({w} - {lag(w, 3)}) / 3",
        "ma_divergence": f"{div(w, roll(w, 12))} - 1",
        "price_entropy": div(roll(w, 12, "stddev_samp"), roll(w, 12)),
        "rsi_proxy": div(f"{w} - {ob}wmp_min", f"{ob}wmp_max - {ob}wmp_min"),
        "rel_spread": div(ob + "spread_mean", ob + "wmp_mean"),
        "z_spread": div(f"{ob}spread_mean - ({roll(ob + 'spread_mean', 12)})", roll(ob + "spread_mean", 12, "stddev_samp")),
        "candle_range": div(f"{t}price_max_trade - {t}price_min_trade", t + "price_mean_trade"),
        "tail_extension": div(f"{t}price_max_trade - {t}price_last_trade", f"{t}price_max_trade - {t}price_min_trade"),
        "trade_imbalance": div(f"{t}volume_buy - {t}volume_sell", total),
        "aggressiveness": div(f"{t}count_buy", f"{t}count_sell"),
        "z_volume": div(f"{total} - ({roll(total, 12)})", roll(total, 12, "stddev_samp")),
        "buy_consumption": div(t + "volume_buy", ob + "sum_ask_50"),
        "sell_consumption": div(t + "volume_sell", ob + "sum_bid_50"),
        "depth_imbalance": div(f"{ob}sum_bid_50 - {ob}sum_ask_50", ob + "total_depth_50"),
        "depth_convexity": div(ob + "sum_bid_5", ob + "sum_bid_50"),
        "liq_density": div(ob + "total_depth_50", ob + "spread_mean"),
        "bid_slope": div(ob + "sum_bid_20", f"{ob}best_bid - {ob}bid_px_20"),
        "ask_slope": div(ob + "sum_ask_20", f"{ob}ask_px_20 - {ob}best_ask"),
        "dist_vwap": div(f"{w} - {vwap}", vwap),
        "dist_max": div(f"{w} - ({roll(w, 12, 'max')})", roll(w, 12, "max")),
        "dist_min": div(f"{w} - ({roll(w, 12, 'min')})", roll(w, 12, "min")),
        "path": f"abs({w} - {lag(w)})",
        "move12": f"abs({w} - {lag(w, 12)})",
    }[name]


def second_sql(name: str, i: str) -> str:
    """Features over features, over ``d``."""
    f = lambda n: f"feat_{n}_{i}"
    path = roll(f("path"), 12, "sum")
    return {
        "trend_divergence": f"{f('log_return_trade')} - {f('log_return_index')}",
        "funding_basis_corr": f"funding_funding_rate * {f('basis_ratio')}",
        "price_accel": f"{f('price_velocity')} - {lag(f('price_velocity'))}",
        "efficiency_ratio": div(path, path),
        "kaufman_ratio": div(f("move12"), path),
        "smart_money_div": f"{f('trade_imbalance')} - {f('depth_imbalance')}",
        "slope_imbalance": div(f("bid_slope"), f("ask_slope")),
        "z_imbalance": div(f"{f('trade_imbalance')} - ({roll(f('trade_imbalance'), 12)})", roll(f("trade_imbalance"), 12, "stddev_samp")),
    }[name]


def derived(first: Sequence[str], second: Sequence[str] = (), shown: Sequence[str] | None = None, intervals: Sequence[str] = ("5m", "15m"), depth: bool = False, hours: bool = False) -> str:
    d = ", ".join(f"{feature_sql(n, i)} AS feat_{n}_{i}" for i in intervals for n in first)
    cols = [f"{r(f'feat_{n}_{i}')} AS feat_{n}_{i}" for i in intervals for n in (shown if shown is not None else first)]
    cols += [f"{r(second_sql(n, i))} AS feat_{n}_{i}" for i in intervals for n in second]
    if hours:
        cols += [f"{r(f'{fn}(2 * pi() * (window_end // 3600000 % 24) / 24)')} AS feat_hour_{fn}" for fn in ("sin", "cos")]
    return f"{gold(intervals, depth)},\nd AS (SELECT *{', ' + d if d else ''} FROM g)\nSELECT window_end, {', '.join(cols)} FROM d"
