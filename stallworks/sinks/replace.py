"""Window-replace writes: a rerun over the same window leaves the same table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators.metrics import day_range
from ..params import DateWindow
from ..sources.tables import day_bounds
from .partitions import drop_days, overwrite_days, partition_days, require_days


def replace_window(df: DataFrame, path: str, day: str, window: DateWindow) -> dict[str, object]:
    """Make the table's days in the window equal ``df``; other days stay untouched.

    Only the window's partitions are written. Days of the window that ``df`` has no
    rows for are removed, so stale days do not survive. A row outside the window stops
    the write: it would replace a day nobody asked to replace. Written days replace old
    ones before stale days are dropped; a run that breaks off in between is healed by the
    next one.
    """
    require_days(df, day)
    spark = df.sparkSession
    inside = F.coalesce(day_bounds(df, day, window.first, window.last), F.lit(False))
    text = F.coalesce(F.col(day).cast("string"), F.lit("null"))
    problem = F.raise_error(F.concat(F.lit("row outside the replaced window: "), text))
    guarded = df.withColumn(day, F.when(inside, F.col(day)).otherwise(problem.cast(df.schema[day].dataType)))

    seen = Observation()
    observed = guarded.observe(seen, F.collect_set(F.col(day).cast("string")).alias("days"))
    overwrite_days(observed, path, day)
    written = {date.fromisoformat(d) for d in seen.get["days"]}
    stale = [d for d in partition_days(spark, path, day) if window.first <= d <= window.last and d not in written]
    drop_days(spark, path, day, stale)
    return {"first": window.first, "last": window.last, "written": sorted(written), "cleared": stale}


def data_window(df: DataFrame, day: str) -> DateWindow | None:
    """The window the result itself covers; None when it holds no valid day."""
    row = day_range(df.select(F.col(day).cast("date").alias(day)), day).first()
    if row is None or row["first"] is None:
        return None
    return DateWindow.of_days(row["first"], row["last"])


def replace_own_window(df: DataFrame, path: str, day: str) -> dict[str, object] | None:
    """Replace the days the result covers; an empty result clears nothing."""
    window = data_window(df, day)
    return None if window is None else replace_window(df, path, day, window)


def replaced(old: DataFrame, new: DataFrame, day: str, window: DateWindow) -> DataFrame:
    """What the table holds after the replacement, as a plan."""
    keep = ~F.coalesce(day_bounds(old, day, window.first, window.last), F.lit(False))
    return old.where(keep).unionByName(new)
