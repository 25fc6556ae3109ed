"""Rate adjustments. Results outside ``[0, 1]`` are null; ``is_rate`` tells which."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .values import ColumnLike, as_col, first_match


def is_rate(c: ColumnLike, low: float = 0.0, high: float = 1.0) -> Column:
    """The value is present and inside the closed range."""
    return F.coalesce(as_col(c).between(low, high), F.lit(False))


def checked_rate(c: ColumnLike, low: float = 0.0, high: float = 1.0) -> Column:
    return F.when(is_rate(c, low, high), as_col(c))


def fixed_rate(value: float) -> Column:
    return checked_rate(F.lit(value))


def shifted_rate(c: ColumnLike, by: float) -> Column:
    return checked_rate(as_col(c) + F.lit(by))


def offset_rate(
    c: ColumnLike, low: float, high: float, keep_above: bool = False
) -> Column:
    """Compress the distance to ``high`` by the relative width of ``[low, high]``."""
    value = as_col(c)
    moved = F.lit(high) + F.lit((high - low) / high) * (value - F.lit(high))
    if keep_above:
        moved = F.when(value >= F.lit(high), value).otherwise(moved)
    return checked_rate(moved)


def ladder_rate(c: ColumnLike, steps: Sequence[float], values: Sequence[float]) -> Column:
    """Value of the first step not below the input; the last value caps the ladder."""
    if len(values) - len(steps) not in (0, 1):
        raise ValueError("a ladder has as many values as steps, or one more")
    value = as_col(c)
    chain = first_match([(value <= F.lit(s), v) for s, v in zip(steps, values)], values[-1])
    return checked_rate(F.when(value.isNotNull(), chain))


def adjustment_direction(is_trial: Column, diff: Column, down: str, same: str, up: str) -> Column:
    """Label of a price move by the sign of the rate difference; non-trial is ``up``."""
    return first_match([(~is_trial, up), (diff < 0, down), (diff == 0, same)], up)
