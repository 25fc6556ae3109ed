"""Ranks, one-row-per-key picks and change detection.

Ranks run over rows that are already one per (group, member): malls inside a
category-day, complaint types inside a category. Such groups are as large as a
dimension, not as the facts. Picking one row per key never builds a window: it is an
aggregate with map-side combine, so a key may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.values import ColumnLike, as_col, nz


def rank_desc(by: Sequence[str], metric: ColumnLike, tiebreak: Sequence[ColumnLike]) -> Column:
    """Position by a measure, largest first, null as 0, ties broken by ``tiebreak``."""
    if not tiebreak:
        raise ValueError("a rank needs a tiebreak to be repeatable")
    order = [nz(metric).desc(), *[as_col(c).asc() for c in tiebreak]]
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))


def rank_then_keep(
    df: DataFrame,
    by: Sequence[str],
    ranks: dict[str, ColumnLike],
    tiebreak: Sequence[ColumnLike],
    keep: Column | None,
) -> DataFrame:
    """Rank all rows, then filter. The filter is on no window key, so it stays above.

    All ranks share one partitioning: one shuffle, one sort per measure.
    """
    ranked = df.withColumns({a: rank_desc(by, m, tiebreak) for a, m in ranks.items()})
    return ranked if keep is None else ranked.where(keep)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group. Spark cuts groups to ``k`` before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike], last: bool = True
) -> DataFrame:
    """The last (or first) row per key in a total order, as an aggregate."""
    if not order:
        raise ValueError("keeping one row per key needs an order")
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[as_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    picked = df.groupBy(*keys).agg(pick(row, rank).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def one_per_key_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where only the keys are read afterwards."""
    return df.select(*keys).distinct()


def previous_value(by: Sequence[str], order: str, column: str) -> Column:
    """Value of the previous row (not the previous calendar day) of the key."""
    return F.lag(column, 1).over(Window.partitionBy(*by).orderBy(order))


def text_changed(current: ColumnLike, previous: ColumnLike) -> Column:
    """The text differs from before; missing text equals empty text."""
    return nz(current, "") != nz(previous, "")
