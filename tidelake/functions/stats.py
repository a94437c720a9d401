"""Aggregates that behave alike on empty, single-row and constant groups, and under ANSI mode.

Every function takes an optional condition and then aggregates only rows that meet it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def given(x: Column, where: Column | None) -> Column:
    return x if where is None else F.when(where, x)


def total(x: Column, where: Column | None = None) -> Column:
    """Sum; 0.0 for no rows."""
    return F.coalesce(F.sum(given(x, where)), F.lit(0.0))


def rows(where: Column | None = None) -> Column:
    return F.count(F.lit(1)) if where is None else F.count_if(where)


def quantile(x: Column, q: float, where: Column | None = None) -> Column:
    """Nearest-rank quantile: the value at place round(q * (n - 1)) in order, halves up."""
    values = F.sort_array(F.collect_list(given(x, where)))
    place = F.round((F.count(given(x, where)) - 1) * F.lit(q)).cast("int")
    return F.get(values, place)


def corr(a: Column, b: Column) -> Column:
    """Pearson correlation; null where a side is constant, instead of an error."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def distinct(x: Column, where: Column | None = None) -> Column:
    """Distinct values; one pass, without the row expansion of several COUNT(DISTINCT)s."""
    return F.size(F.collect_set(given(x, where))).cast("long")


def first_by(x: Column, order: Column, where: Column | None = None) -> Column:
    return F.min_by(x, given(order, where)) if where is not None else F.min_by(x, order)


def last_by(x: Column, order: Column, where: Column | None = None) -> Column:
    return F.max_by(x, given(order, where)) if where is not None else F.max_by(x, order)


def ratio(a: Column, b: Column) -> Column:
    """a / (b + 1e-9), null where the divisor is exactly 0."""
    return F.try_divide(a, b + F.lit(EPS))


def q(name: str) -> str:
    """A column name quoted, since metric names hold dots."""
    return f"`{name}`"


def col(name: str) -> Column:
    return F.col(q(name))
