"""Conditional KPI aggregates in one pass.

A distinct count under a condition costs Spark one copy of the input per count when
written as ``count(distinct case ...)``. Here the counts of one entity share a first
aggregation on (group, entity) that keeps a 0/1 mark per condition; the second adds
the marks up. Both levels combine on the map side, so a hot group or entity arrives
at its reducer already reduced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import flag


@dataclass
class Metrics:
    """What to compute per group.

    sums       {alias: expression to add up}
    maxima     {alias: expression}
    distincts  {alias: (entity expression, condition or None)}
    """

    sums: dict[str, Column] = field(default_factory=dict)
    maxima: dict[str, Column] = field(default_factory=dict)
    distincts: dict[str, tuple[Column | str, Column | None]] = field(default_factory=dict)

    @staticmethod
    def when_sum(cond: Column, value: Column) -> Column:
        """Conditional sum term: the value where the condition holds, else 0."""
        return F.when(cond, value).otherwise(F.lit(0))

    def names(self) -> list[str]:
        return [*self.sums, *self.maxima, *self.distincts]


def _entity_name(entity: Column | str) -> str:
    return entity if isinstance(entity, str) else str(entity)


def aggregate(df: DataFrame, by: Sequence[str], metrics: Metrics) -> DataFrame:
    """Group ``df`` and compute every metric exactly, reading the input once.

    Entities of different kinds share the pass: a row is copied once per kind, and each
    copy keeps the key of its own kind only. Sums and maxima ride on the first kind.
    """
    by = list(by)
    kinds: dict[str, list[str]] = {}
    for name, (entity, _) in metrics.distincts.items():
        kinds.setdefault(_entity_name(entity), []).append(name)
    if not kinds:
        return df.groupBy(*by).agg(
            *[F.sum(e).alias(a) for a, e in metrics.sums.items()],
            *[F.max(e).alias(a) for a, e in metrics.maxima.items()],
        )
    entities = [metrics.distincts[names[0]][0] for names in kinds.values()]
    columns = [F.col(e) if isinstance(e, str) else e for e in entities]
    if len(kinds) == 1:
        of_kind = lambda i, c: c
        keys = [columns[0].alias("__e0")]
        rows = df
    else:
        kind = F.col("__kind")
        of_kind = lambda i, c: F.when(kind == i, c)
        keys = [of_kind(i, c).alias(f"__e{i}") for i, c in enumerate(columns)] + [kind]
        rows = df.withColumn("__kind", F.explode(F.array(*[F.lit(i) for i in range(len(kinds))])))
    marks = []
    for i, names in enumerate(kinds.values()):
        for name in names:
            cond = metrics.distincts[name][1]
            met = columns[i].isNotNull() if cond is None else cond & columns[i].isNotNull()
            marks.append(F.max(F.coalesce(of_kind(i, flag(met)), F.lit(0))).alias(name))
    first = rows.groupBy(*by, *keys).agg(
        *[F.sum(of_kind(0, e)).alias(a) for a, e in metrics.sums.items()],
        *[F.max(of_kind(0, e)).alias(a) for a, e in metrics.maxima.items()],
        *marks,
    )
    return first.groupBy(*by).agg(
        *[F.sum(a).alias(a) for a in metrics.sums],
        *[F.max(a).alias(a) for a in metrics.maxima],
        *[F.sum(n).cast("bigint").alias(n) for n in metrics.distincts],
    )


def pick_preferred(
    df: DataFrame,
    by: Sequence[str],
    attributes: Sequence[str],
    preferred: Column,
    null_is_other: bool = True,
) -> DataFrame:
    """Per group and attribute: the preferred rows' value, else the other rows' value.

    ``null_is_other`` decides whether rows with an unknown preference count as other
    rows or as neither.
    """
    others = ~F.coalesce(preferred, F.lit(False)) if null_is_other else ~preferred
    picks = [
        F.coalesce(F.max(F.when(preferred, F.col(a))), F.max(F.when(others, F.col(a)))).alias(a)
        for a in attributes
    ]
    return df.groupBy(*by).agg(*picks)


def group_counts(df: DataFrame, by: Sequence[str], entity: str) -> DataFrame:
    """Rows and distinct entities per group, for any grouping."""
    return aggregate(
        df,
        by,
        Metrics(
            sums={"n_rows": flag(F.col(entity).isNotNull())},
            distincts={"n_distinct": (entity, None)},
        ),
    )


def collect_map(df: DataFrame, by: Sequence[str], key: str, value: str) -> DataFrame:
    """Per group a map ``key -> sorted distinct values``.

    Duplicates are removed by two aggregations before anything is collected, so an
    array holds distinct values only, however many rows repeat them.
    """
    unique = df.select(*by, key, value).distinct()
    lists = unique.groupBy(*by, key).agg(F.sort_array(F.collect_list(value)).alias(value))
    entries = F.sort_array(F.collect_list(F.struct(F.col(key), F.col(value))))
    return lists.where(F.col(key).isNotNull()).groupBy(*by).agg(
        F.map_from_entries(entries).alias("items")
    )


def day_range(df: DataFrame, column: str) -> DataFrame:
    """First and last day of a column, for a data-driven window."""
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
