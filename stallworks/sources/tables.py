"""Scans of daily-partitioned tables.

Every filter compares the stored column itself with a literal of its own type, so
it prunes partitions or reaches the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..params import DateWindow, SourceOffsets


def _is_timestamp(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType))


def day_bounds(df: DataFrame, column: str, first: date | None, last: date | None) -> Column:
    """``first <= day <= last`` on a date, timestamp or ``yyyy-MM-dd`` text column."""
    data_type = df.schema[column].dataType
    col = F.col(column)
    if isinstance(data_type, T.StringType):
        low, high = first and first.isoformat(), last and last.isoformat()
        upper = col <= F.lit(high)
    elif _is_timestamp(data_type):
        midnight = lambda d: F.lit(datetime.combine(d, time())).cast(data_type)
        low = first and midnight(first)
        upper = col < midnight(last + timedelta(days=1)) if last else None
    else:
        low, upper = first, col <= F.lit(last)
    parts = []
    if first is not None:
        parts.append(col >= (low if isinstance(low, Column) else F.lit(low)))
    if last is not None:
        parts.append(upper)
    if not parts:
        return F.lit(True)
    return parts[0] if len(parts) == 1 else parts[0] & parts[1]


def scan_window(
    df: DataFrame, column: str, window: DateWindow, lookback: int = 0, lookahead: int = 0
) -> DataFrame:
    """Rows of the window, widened when lags or rolling sums need earlier days."""
    wide = window.padded(lookback, lookahead)
    return df.where(day_bounds(df, column, wide.first, wide.last))


def scan_from(df: DataFrame, column: str, window: DateWindow, offsets: SourceOffsets) -> DataFrame:
    """Rows of one source's own window; its upper bound may be open."""
    first, last = offsets.bounds(window)
    return df.where(day_bounds(df, column, first, last))


def scan_day(df: DataFrame, column: str, base: date, lag: int = 0) -> DataFrame:
    """Rows of exactly ``base - lag`` days."""
    day = base - timedelta(days=lag)
    return df.where(day_bounds(df, column, day, day))


def latest_snapshot(df: DataFrame, column: str, minus: int = 0) -> DataFrame:
    """Rows of the newest day that has data, or of ``minus`` days before it.

    The day is a scalar subquery, so on a partition column it prunes at run time.
    Unlike a catalogue lookup it ignores partitions without rows.
    """
    newest = df.select(F.max(F.col(column)).alias("day")).scalar()
    if not minus:
        return df.where(F.col(column) == newest)
    data_type = df.schema[column].dataType
    return df.where(F.col(column) == F.date_add(newest.cast("date"), -minus).cast(data_type))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column projection at the source; Catalyst carries it into the reader."""
    return df.select(*columns)


def one_row(spark: SparkSession) -> DataFrame:
    """The constant one-row relation."""
    return spark.range(1).select(F.lit(1).alias("dummy"))


def day_spine(spark: SparkSession, window: DateWindow, name: str = "dt") -> DataFrame:
    """One row per calendar day of the window."""
    days = F.sequence(F.lit(window.first), F.lit(window.last), F.expr("interval 1 day"))
    return one_row(spark).select(F.explode(days).alias(name))
