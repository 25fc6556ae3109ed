"""Stages of a trial laid out on calendar days, and lookups of the latest entry before a day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

WEEK = 7
GRAINS = ("day", "whole", "week")


def check_stages(stages: DataFrame) -> DataFrame:
    """``stages`` unless two of them share a day, one ends before it starts, or a grain is unknown.

    A configuration table: one row per stage, looked at in order of the first days.
    """
    before = Window.orderBy("first", "last", "stage").rowsBetween(Window.unboundedPreceding, -1)
    bad = (
        stages.withColumn("__until", F.max("last").over(before))
        .where(
            (F.col("first") > F.col("last"))
            | (F.col("__until") >= F.col("first"))
            | ~F.col("grain").isin(list(GRAINS))
        )
        .select("stage")
        .first()
    )
    if bad is not None:
        raise ValueError(f"stage {bad['stage']!r} overlaps another one, ends before it starts or has no known grain")
    return stages


def trading_spine(first: Column | date, last: Column | date, holidays: DataFrame, source: DataFrame) -> DataFrame:
    """``day, is_trading, trading_no`` for the days between two bounds.

    ``trading_no`` counts the trading days up to the day, so those from one day to another
    are ``trading_no(b) - trading_no(a) + is_trading(a)``. The running count takes one task,
    of one row per calendar day. ``source`` is the one-row relation that knows the bounds.
    """
    as_col = lambda c: c if isinstance(c, Column) else F.lit(c)
    days = source.select(F.explode(F.sequence(as_col(first), as_col(last), F.expr("interval 1 day"))).alias("day"))
    off = holidays.select(F.col("day").cast("date").alias("day")).where("day IS NOT NULL").distinct()
    marked = days.join(off.withColumn("__off", F.lit(1)), "day", "left")
    trading = F.when(F.col("__off").isNull(), 1).otherwise(0)
    running = F.sum("is_trading").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return marked.select("day", trading.alias("is_trading")).withColumn("trading_no", running)


def stage_calendar(stages: DataFrame, holidays: DataFrame, until: date) -> DataFrame:
    """One row per day of a stage with the period that the day is reported in.

    ``stages`` has ``stage, first, last, grain``: ``day`` reports every day, ``whole`` the
    stage, ``week`` seven days at a time from the stage's first day on. A week is complete
    when it has seven days that lie in the stage and not after ``until``. ``trading_days``
    are those of the period up to ``until`` that are no holidays.
    """
    stages = check_stages(stages.select("stage", "grain", F.col("first").cast("date").alias("first"), F.col("last").cast("date").alias("last")))
    bounds = stages.agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first IS NOT NULL")
    spine = trading_spine(F.col("first"), F.col("last"), holidays, bounds)
    days = stages.withColumn("day", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))))
    week = F.floor(F.datediff("day", "first") / WEEK).cast("int")
    weekly, daily = F.col("grain") == "week", F.col("grain") == "day"
    days = days.withColumns(
        {
            "week_no": F.when(weekly, week + 1),
            "period_first": F.when(daily, F.col("day")).when(weekly, F.date_add("first", week * WEEK)).otherwise(F.col("first")),
        }
    )
    seventh = F.date_add("period_first", WEEK - 1)
    days = days.withColumns(
        {
            "period_last": F.when(daily, F.col("day")).when(weekly, F.least(seventh, F.col("last"))).otherwise(F.col("last")),
            "is_complete_week": F.when(weekly, (seventh <= F.col("last")) & (seventh <= F.lit(until))),
            "stage_week": F.when(weekly, F.concat_ws("_W", "stage", "week_no")),
        }
    )
    period = Window.partitionBy("stage", "period_first")
    seen = F.col("day") <= F.lit(until)
    number = F.when(seen, F.col("trading_no"))
    before = F.col("trading_no") - F.col("is_trading")
    return (
        days.join(spine, "day")
        .withColumn("trading_days", F.coalesce(F.max(number).over(period) - F.min(before).over(period), F.lit(0)).cast("int"))
        .select(
            "day", "stage", "grain", "week_no", "stage_week", "period_first", "period_last",
            "is_complete_week", "trading_days", "is_trading", "trading_no",
        )
    )


def asof_lookup(probes: DataFrame, entries: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], found: str = "as_of") -> DataFrame:
    """For each probe the values of its key's latest entry on or before the day; null where none is.

    Entries and probes of a key go through one ordered pass instead of a range join. Entries
    are reduced to one per key and day first (the largest values of a day), probes to
    distinct days, so a pass is bounded by twice the number of days however hot the key is.
    """
    keys = list(keys)
    entry = entries.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.max(F.struct(*values)).alias("__value"))
    entry = entry.select(*keys, day, F.struct(F.col(day).alias("day"), "__value").alias("__entry"), F.lit(0).alias("__probe"))
    asked = probes.select(*keys, day).distinct().withColumns({"__entry": F.lit(None), "__probe": F.lit(1)})
    order = Window.partitionBy(*keys).orderBy(day, "__probe").rowsBetween(Window.unboundedPreceding, 0)
    rows = entry.unionByName(asked).withColumn("__last", F.last("__entry", ignorenulls=True).over(order))
    return rows.where("__probe = 1").select(
        *keys, day, F.col("__last.day").alias(found), *[F.col(f"__last.__value.{v}").alias(v) for v in values]
    )
