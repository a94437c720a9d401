"""Windows out of panes: rows are aggregated once, and panes, not rows, are copied to windows.

A pane is one step long.  It keeps counts, sums, extremes, central moments and, where values themselves are asked
for (quantiles, distinct values), their list.  Panes go to the days whose windows hold them, so a day's windows are
made in one task without another shuffle, and what is written to disk does not grow with size / step.  Moments are
added up as deviations from the day's centre, so that large values don't cancel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions import stats as S
from tidelake.functions.intervals import DAY_MS

from . import windows as W


def suits(size: int, step: int) -> bool:
    """Windows of several panes; those of one need none."""
    return size > step and size % step == 0 and DAY_MS % step == 0


def _sum(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0.0))


class Recipe:
    """What to take of each pane (over rows with ``_pane``), of its windows (over panes with ``window_end``), and from that.

    Metrics that are not among ``only`` are left out.  ``source`` is the time that says which days have rows, where
    that is not ``time``.
    """

    def __init__(self, time: str, size: int, step: int, only: Sequence[str] = (), source: str | None = None):
        self.time, self.size, self.step, self.only, self.source = time, size, step, set(only), source
        self.pane: dict[str, Column] = {}
        self.centres: dict[str, tuple[str, Column]] = {}  # means over a window, from a pane's counts and means
        self.lists: dict[str, Column] = {}  # values a pane lists
        self.sorted: dict[str, list[str]] = {}  # a window's ordered values, out of these lists
        self.values: dict[str, Column] = {}  # what is taken of them
        self.window: dict[str, Column] = {}
        self.out: dict[str, Column] = {}

    def wants(self, *names: str | None) -> bool:
        return not self.only or not self.only.isdisjoint(names)

    def _both(self, name: str, pane: Column, window) -> Column:
        self.pane[f"_{name}"] = pane
        self.window[f"_{name}"] = window(F.col(f"`_{name}`"))
        return F.col(f"`_{name}`")

    def sum(self, name: str, x: Column) -> None:
        if not self.wants(name):
            return
        self.out[name] = F.coalesce(self._both(name, F.sum(x), F.sum), F.lit(0.0))

    def rows(self, name: str, where: Column | None = None) -> None:
        if not self.wants(name):
            return
        self.out[name] = F.coalesce(self._both(name, S.rows(where), F.sum), F.lit(0))

    def low(self, name: str, x: Column) -> None:
        if not self.wants(name):
            return
        self.out[name] = self._both(name, F.min(x), F.min)

    def high(self, name: str, x: Column) -> None:
        if not self.wants(name):
            return
        self.out[name] = self._both(name, F.max(x), F.max)

    def edge(self, name: str, x: Column, order: Column, last: bool, where: Column | None = None) -> None:
        """The value of the first or last row; panes come one after another, so rows are ordered in panes only."""
        if not self.wants(name):
            return
        by = F.max_by if last else F.min_by
        at = f"_at_{name}"
        self.pane[at] = F.when(S.rows(where) > 0, F.max("_pane"))
        self.out[name] = self._both(name, by(x, S.given(order, where)), lambda v: by(v, F.col(f"`{at}`")))

    def _centre(self, name: str, n: str, mean: str) -> Column:
        self.centres[f"_c_{name}"] = (n, F.col(f"`{mean}`"))
        return F.col(f"`{mean}`") - F.col(f"`_c_{name}`")

    def _moments(self, name: str, x: Column, most: int) -> tuple[Column, list[Column], Column]:
        """Count, mean and central sums up to the given power, over the window, and whether all values are the same."""
        p = f"m_{name}"
        self.pane |= {f"_{p}_n": F.count(x), f"_{p}_a": F.avg(x), f"_{p}_v": F.var_pop(x), f"_{p}_lo": F.min(x), f"_{p}_hi": F.max(x)}
        if most > 2:
            self.pane |= {f"_{p}_s": F.skewness(x), f"_{p}_k": F.kurtosis(x)}
        n, d, v = F.col(f"`_{p}_n`"), self._centre(p, f"_{p}_n", f"_{p}_a"), F.col(f"`_{p}_v`")
        m2 = n * v
        self.window |= {f"_{p}_n": F.sum(n), f"_{p}_1": _sum(n * d), f"_{p}_2": _sum(m2 + n * d * d), f"_{p}_lo": F.min(f"`_{p}_lo`"), f"_{p}_hi": F.max(f"`_{p}_hi`")}
        self.window[f"_{p}_c"] = F.max(f"`_c_{p}`")
        if most > 2:
            m3 = F.coalesce(F.col(f"`_{p}_s`"), F.lit(0.0)) * m2 * F.sqrt(v)
            m4 = F.coalesce(F.col(f"`_{p}_k`") + 3, F.lit(0.0)) * m2 * v
            self.window |= {f"_{p}_3": _sum(m3 + 3 * d * m2 + n * d * d * d), f"_{p}_4": _sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d)}
        c = lambda k: F.col(f"`_{p}_{k}`")
        finite = lambda x: x - x == 0
        still = (c("lo") == c("hi")) & finite(c("lo"))
        e = F.try_divide(c(1), c("n"))
        sums = [F.when(c("n") > 0, F.when(finite(c("c")), c("c") + e).otherwise(c("c"))), F.when(still, F.lit(0.0)).otherwise(F.greatest(c(2) - c(1) * e, F.lit(0.0)))]
        if most > 2:
            sums += [c(3) - 3 * e * c(2) + 2 * c("n") * e * e * e, c(4) - 4 * e * c(3) + 6 * e * e * c(2) - 3 * c("n") * e * e * e * e]
        return c("n"), sums, still

    def spread(self, name: str, x: Column, mean: str | None, std: str | None, skew: str | None = None, kurtosis: str | None = None) -> None:
        if not self.wants(mean, std, skew, kurtosis):
            return
        n, m, still = self._moments(name, x, 4 if skew else 2)
        if mean:
            self.out[mean] = m[0]
        if std:
            self.out[std] = F.when(n > 1, F.sqrt(m[1] / (n - 1)))
        if skew:
            self.out[skew] = F.when(~still, F.sqrt(n.cast("double")) * F.try_divide(m[2], F.pow(m[1], F.lit(1.5))))
            self.out[kurtosis] = F.when(~still, n * F.try_divide(m[3], m[1] * m[1]) - 3)

    def corr(self, name: str, a: Column, b: Column, age: bool = False) -> None:
        """Pearson correlation of a and b over rows that have both; with the window's end minus the time as b, if asked."""
        if not self.wants(name):
            return
        both = a.isNotNull() & b.isNotNull()
        x, y, p = F.when(both, a), F.when(both, b), f"r_{name}"
        self.pane |= {f"_{p}_n": F.count(x), f"_{p}_xy": F.covar_pop(x, y)}
        for k, v in (("x", x), ("y", y)):
            self.pane |= {f"_{p}_{k}a": F.avg(v), f"_{p}_{k}v": F.var_pop(v), f"_{p}_{k}lo": F.min(v), f"_{p}_{k}hi": F.max(v)}
        g = lambda k: F.col(f"`_{p}_{k}`")
        n, dx, dy = g("n"), self._centre(f"{p}_x", f"_{p}_n", f"_{p}_xa"), self._centre(f"{p}_y", f"_{p}_n", f"_{p}_ya")
        late = F.lit(0.0)
        if age:  # ages are a pane's own till here, so the centre is that of minus the time, to which the pane's end is near
            late = (F.col("window_end") - F.col("_pane")).cast("double")
            self.centres[f"_c_{p}_y"] = (f"_{p}_n", g("ya") - F.col("_pane"))
            dy = g("ya") + (-F.col("_pane").cast("double") - F.col(f"`_c_{p}_y`"))
        self.window |= {
            f"_{p}_n": F.sum(n), f"_{p}_x": _sum(n * dx), f"_{p}_y": _sum(n * dy), f"_{p}_xx": _sum(n * (g("xv") + dx * dx)), f"_{p}_yy": _sum(n * (g("yv") + dy * dy)), f"_{p}_xy": _sum(n * (g("xy") + dx * dy)),
            f"_{p}_xlo": F.min(g("xlo")), f"_{p}_xhi": F.max(g("xhi")), f"_{p}_ylo": F.min(g("ylo") + late), f"_{p}_yhi": F.max(g("yhi") + late),
        }
        moves = (g("xlo") < g("xhi")) & (g("ylo") < g("yhi"))
        xx, yy, xy = g("xx") - g("x") * g("x") / g("n"), g("yy") - g("y") * g("y") / g("n"), g("xy") - g("x") * g("y") / g("n")
        self.out[name] = F.when(moves, F.try_divide(xy, F.sqrt(F.greatest(xx, F.lit(0.0))) * F.sqrt(F.greatest(yy, F.lit(0.0)))))

    def _head(self, name: str, prev: Column, x: Column) -> tuple[Column, Column]:
        """Rows whose previous one lies in their pane, and the value of the one row whose previous row lies before it, if in the window."""
        start = F.col("_pane") - F.lit(self.step)
        self.pane |= {f"_{name}_hp": F.max(F.when(prev < start, prev)), f"_{name}_hx": F.max(F.when(prev < start, x))}
        return prev >= start, F.when(F.col(f"`_{name}_hp`") >= F.col("window_end") - F.lit(self.size), F.col(f"`_{name}_hx`"))

    def gaps(self, label: str, suffix: str, prev: Column, where: Column | None = None) -> None:
        """Mean, deviation, extremes of the time since the previous row, where that lies in the window."""
        names = [f"rate_{n}_ms{suffix}" for n in ("mean", "std", "max", "min")]
        if not self.wants(*names):
            return
        gap = S.given(F.col(self.time) - prev, where)
        p = f"g_{label}"
        inside, head = self._head(p, S.given(prev, where), gap)
        x = F.when(inside, gap)
        self.pane |= {f"_{p}_n": F.count(x), f"_{p}_1": F.sum(x), f"_{p}_2": F.sum(x * x), f"_{p}_lo": F.min(x), f"_{p}_hi": F.max(x)}
        g = lambda k: F.col(f"`_{p}_{k}`")
        # times are whole, so their sums are exact; a gap is shorter than the window
        zero, whole = lambda v: F.coalesce(v, F.lit(0)), lambda v: v.cast("decimal(38,0)")
        self.window |= {
            f"_{p}_n": F.sum(g("n") + F.when(head.isNotNull(), 1).otherwise(0)), f"_{p}_1": F.sum(zero(g(1)) + zero(head)), f"_{p}_2": F.sum((zero(g(2)) + zero(head * head)).cast("decimal(27,0)")),
            f"_{p}_lo": F.min(F.least(g("lo"), head)), f"_{p}_hi": F.max(F.greatest(g("hi"), head)),
        }
        n = g("n").cast("decimal(11,0)")
        one = g(1).cast("decimal(19,0)")
        square = (whole(n * g(2)) - whole(one * one)).cast("double") / (g("n") * (g("n") - 1))
        self.out |= {f"rate_mean_ms{suffix}": F.when(g("n") > 0, g(1) / g("n")), f"rate_std_ms{suffix}": F.when(g("n") > 1, F.sqrt(square)), f"rate_max_ms{suffix}": g("hi").cast("double"), f"rate_min_ms{suffix}": g("lo").cast("double")}

    def moved(self, name: str, prev: Column, test: Column) -> None:
        """Rows that pass the test against their previous row, where that lies in the window."""
        if not self.wants(name):
            return
        inside, head = self._head(name, prev, F.when(test, 1).otherwise(0))
        self.pane[f"_{name}"] = F.count_if(inside & test)
        self.window[f"_{name}"] = F.sum(F.col(f"`_{name}`") + F.coalesce(head, F.lit(0)))
        self.out[name] = F.coalesce(F.col(f"`_{name}`"), F.lit(0))

    def value(self, name: str, of: str, lists: dict[str, Column], take, none: Column | None = None) -> None:
        """What is taken of all values of the window in order, out of the lists of several populations."""
        if not self.wants(name):
            return
        self.lists |= {f"_l_{k}": v for k, v in lists.items()}
        self.sorted[f"_o_{of}"] = [f"_l_{k}" for k in lists]
        self.values[f"_v_{name}"] = take(F.col(f"`_o_{of}`"))
        self.window[f"_v_{name}"] = F.max(f"`_v_{name}`")
        self.out[name] = F.col(f"`_v_{name}`") if none is None else F.coalesce(F.col(f"`_v_{name}`"), none)


def nth(values: Column, q: float) -> Column:
    """Nearest rank, as stats.quantile() has it."""
    return F.get(values, F.round((F.size(values) - 1) * F.lit(q)).cast("int"))


def combine(rows: DataFrame, recipe: Recipe, keys: Sequence[str] = ()) -> DataFrame:
    """Keys, window_end and what the recipe gives; windows of days without rows, and empty ones, have no row."""
    size, step = recipe.size, recipe.step
    own = [F.col(k) for k in keys]
    lists = [F.collect_list(v).alias(n) for n, v in recipe.lists.items()]
    day = lambda end: F.floor((end - 1) / F.lit(DAY_MS))
    p, first, last = F.col("_pane"), F.col("_day") * DAY_MS + F.lit(step), F.col("_day") * DAY_MS + F.lit(DAY_MS)
    begins, ends, live, sources = day(p), day(p + F.lit(size - step)), day(p) == F.col("_day"), []
    if recipe.source:  # a pane's rows are of two such days at most; it goes to these days too, to say that they have rows
        at = F.floor(F.col(recipe.source) / F.lit(DAY_MS))
        sources = [F.min(at).alias("_d0"), F.max(at).alias("_d1")]
        begins, ends, live = F.least(begins, F.col("_d0")), F.greatest(ends, F.col("_d1")), F.col("_day").isin(F.col("_d0"), F.col("_d1"))
    panes = rows.withColumn("_pane", W.pane_of(F.col(recipe.time), step)).groupBy(*own, "_pane").agg(*[v.alias(n) for n, v in recipe.pane.items()], *sources, *lists)
    each = panes.withColumn("_day", F.explode(F.sequence(begins, ends))).repartition(*own, F.col("_day"))
    whole = Window.partitionBy(*own, F.col("_day"))
    after = F.lead("_pane").over(whole.orderBy("_pane"))
    each = each.withColumns({"_live": F.max(live).over(whole), "_next": F.coalesce(after, last + F.lit(step))}).where("_live").drop("_live")
    # a row a pane, and one for each end after it that no pane has; the last pane before a day has those up to the day's first
    begin, to = F.greatest(p + F.lit(step), first), F.least(F.col("_next") - F.lit(step), p + F.lit(size - step), last)
    more = F.when(to >= begin, F.sequence(begin, to, F.lit(step))).otherwise(F.array().cast("array<long>"))
    each = each.withColumn("window_end", F.explode(F.concat(F.array(p), more))).drop("_next")
    frame = whole.orderBy("window_end").rangeBetween(-(size - step), 0)
    here = lambda x: F.when(F.col("window_end") == p, x)
    stats = [F.col(f"`{c}`") for c in ("_pane", *recipe.pane)]
    held = {"_panes": F.collect_list(here(F.struct(*stats))).over(frame), **{n: F.collect_list(here(F.col(n))).over(frame) for n in recipe.lists}}
    for c, (n, mean) in recipe.centres.items():
        held[c] = F.coalesce(F.try_divide(F.sum(here(F.col(f"`{n}`") * mean)).over(frame), F.sum(here(F.col(f"`{n}`"))).over(frame)), F.lit(0.0))
    each = each.select(*own, "_day", "window_end", *[v.alias(c) for c, v in held.items()]).where(F.col("window_end").between(first, last))
    kept = [F.col(f"`{c}`") for c in ("window_end", "_panes", *recipe.centres)]
    each = each.select(*own, "_day", *kept, *[F.sort_array(F.flatten(F.concat(*[F.col(c) for c in cs]))).alias(n) for n, cs in recipe.sorted.items()])
    each = each.select(*own, "_day", *kept, *[v.alias(n) for n, v in recipe.values.items()])
    each = each.withColumn("_panes", F.explode("_panes")).select(*own, "_day", "window_end", *[F.col(f"`{c}`") for c in (*recipe.centres, *recipe.values)], "_panes.*")
    got = each.groupBy(*own, "_day", "window_end").agg(*[v.alias(n) for n, v in recipe.window.items()])
    return got.select(*own, "window_end", *[v.alias(n) for n, v in recipe.out.items() if recipe.wants(n)])
