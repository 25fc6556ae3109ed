"""Deletion predicates given as data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, functions as F

#: Operator names.
OPERATORS = (
    "is",
    "isNot",
    "contains",
    "doesNotContain",
    "isEmpty",
    "isNotEmpty",
    "isGreater",
    "isGreaterEqual",
    "isLess",
    "isLessEqual",
)


@dataclass(frozen=True)
class Condition:
    field: str
    op: str
    value: object = None

    def __post_init__(self) -> None:
        if self.op not in OPERATORS:
            raise ValueError(f"unknown operator {self.op!r}")

    def to_column(self) -> Column:
        col, value = F.col(self.field), self.value
        if self.op in ("isEmpty", "isNotEmpty"):
            empty = col.isNull() | (F.trim(col.cast("string")) == "")
            return empty if self.op == "isEmpty" else ~empty
        if value is None:
            raise ValueError(f"operator {self.op!r} on {self.field!r} needs a value")
        if self.op == "is":
            return col == F.lit(value)
        if self.op == "isNot":
            return col != F.lit(value)
        if self.op == "contains":
            return F.contains(col, F.lit(value))
        if self.op == "doesNotContain":
            return ~F.contains(col, F.lit(value))
        if self.op == "isGreater":
            # A lower bound on a day includes that day.
            inclusive = isinstance(value, (date, datetime))
            return col >= F.lit(value) if inclusive else col > F.lit(value)
        if self.op == "isGreaterEqual":
            return col >= F.lit(value)
        if self.op == "isLess":
            return col < F.lit(value)
        return col <= F.lit(value)


def predicate(conditions: list[Condition], conjunction: str = "and") -> Column:
    """One predicate out of many; an empty list is refused, it would match all rows."""
    if not conditions:
        raise ValueError("refusing an empty predicate")
    if conjunction not in ("and", "or"):
        raise ValueError("conjunction is 'and' or 'or'")
    parts = [F.coalesce(c.to_column(), F.lit(False)) for c in conditions]
    join = (lambda a, b: a & b) if conjunction == "and" else (lambda a, b: a | b)
    return reduce(join, parts)


def day_window(field: str, first: date, last: date) -> list[Condition]:
    """Conditions for the closed window ``[first, last]``."""
    return [
        Condition(field, "isGreater", first),
        Condition(field, "isLess", last + timedelta(days=1)),
    ]
