"""Null-safe numbers, flags and bins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: ColumnLike, default: object = 0) -> Column:
    """The value, or ``default`` for null."""
    return F.coalesce(as_col(c), F.lit(default))


def raw_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` as double, null where the denominator is zero or null."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def ratio(num: ColumnLike, den: ColumnLike, digits: int | None = 5) -> Column:
    """Null-safe ratio, 0 where it is undefined, rounded half up."""
    value = F.coalesce(raw_ratio(num, den), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_one_of(c: ColumnLike, values: Iterable[object]) -> Column:
    return as_col(c).isin(list(values))


def any_positive(*cols: ColumnLike) -> Column:
    """Some of the measures is active: the null-free sum is above zero."""
    return reduce(lambda a, b: a + b, [nz(c) for c in cols]) > 0


def half_open(c: ColumnLike, low: float, high: float) -> Column:
    """``low <= c < high``."""
    return (as_col(c) >= F.lit(low)) & (as_col(c) < F.lit(high))


def to_number(c: ColumnLike, default: float | None = None) -> Column:
    """Text to double; what does not parse is null, or ``default``."""
    value = as_col(c).try_cast("double")
    value = F.when(~F.isnan(value), value)
    return value if default is None else F.coalesce(value, F.lit(default))


def first_match(pairs: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Searched CASE: the label of the first condition that holds."""
    expr = None
    for cond, label in pairs:
        label = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if expr is None:
        raise ValueError("first_match needs at least one pair")
    if otherwise is None:
        return expr
    return expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def relabel(c: ColumnLike, labels: dict[str, str], keep_unknown: bool = True) -> Column:
    """Enum code to label; unknown codes pass through unless told otherwise."""
    col = as_col(c)
    pairs = [(col == F.lit(k), F.lit(v)) for k, v in labels.items()]
    return first_match(pairs, col if keep_unknown else None)


def presence(c: ColumnLike, present: object, absent: object) -> Column:
    """Label rows by whether an outer join found a partner."""
    return F.when(as_col(c).isNotNull(), F.lit(present)).otherwise(F.lit(absent))


def price_net_of_rate(price: ColumnLike, rate: ColumnLike, digits: int = 2) -> Column:
    """Supply price below a commission: ``price / (1 + rate)``."""
    return F.round(raw_ratio(price, F.lit(1.0) + as_col(rate).cast("double")), digits)


def finite_or_null(c: ColumnLike) -> Column:
    """Double for a sink: decimals become doubles, NaN and infinities become null."""
    value = as_col(c).cast("double")
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(~bad, value)
