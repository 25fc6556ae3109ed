"""Rolling measures on a calendar spine, and repeated entities.

Both start from one row per (key, day), which the caller gets by aggregating the
facts. From there a key owns at most one row per day, so a window partition is
bounded by the number of days whatever the skew of the facts was.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..params import DateWindow

_UNIX_DAY = date(1970, 1, 1)
_DAY_NO = "__day_no"


@dataclass(frozen=True)
class Band:
    """Days at distance ``near`` to ``far`` from the output day, both included.

    ``Band("d7", 0, 6)`` is the output day and the six before it; ``Band("p7", 7, 13)``
    the seven days before those.
    """

    name: str
    near: int
    far: int

    def __post_init__(self) -> None:
        if not 0 <= self.near <= self.far:
            raise ValueError("a band needs 0 <= near <= far")


def _forward(direction: str) -> bool:
    if direction not in ("backward", "forward"):
        raise ValueError("direction is 'backward' or 'forward'")
    return direction == "forward"


def spine_expand(
    df: DataFrame, day: str, window: DateWindow, near: int, far: int,
    direction: str = "backward", out: str = "spine_dt",
) -> DataFrame:
    """Range join of facts to spine days, written as an explode.

    Each fact row is copied to the output days it contributes to, at most
    ``far - near + 1`` of them, clipped to the window. No theta join, no dummy key.
    """
    fact = F.col(day)
    if _forward(direction):
        low, high = F.date_add(fact, -far), F.date_add(fact, -near)
    else:
        low, high = F.date_add(fact, near), F.date_add(fact, far)
    low = F.greatest(low, F.lit(window.first))
    high = F.least(high, F.lit(window.last))
    days = F.when(low <= high, F.sequence(low, high, F.expr("interval 1 day")))
    return df.withColumn(out, F.explode(days))


def rolling_by_spine(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    window: DateWindow,
    measures: Sequence[str],
    bands: Sequence[Band],
    active_days: dict[str, Column] | None = None,
    horizon: int | None = None,
    direction: str = "backward",
) -> DataFrame:
    """Per key and spine day: same-day values, band sums and active days per band.

    ``df`` holds one row per (key, day). A key has an output row on every day of the
    window that sees some fact within ``horizon`` days, with 0 as the same-day value
    when that day itself has none. ``active_days`` maps a name to a condition on the
    daily row; the result counts the days in the band on which it held.

    direction: ``backward`` sums ``[T - far, T - near]``, which is what "last 7 days"
    says. ``forward`` sums ``[T + near, T + far]``, the direction the upstream report
    text evaluates to when its range predicate is solved for the fact day.

    Plan: one shuffle by key. Each fact is copied only to the days before the key's
    next fact, so the copies of a key are disjoint days; the sums are range frames
    over that dense series.
    """
    forward = _forward(direction)
    active_days = active_days or {}
    horizon = max(b.far for b in bands) if horizon is None else horizon
    marks = {f"__act_{n}": F.when(c, 1).otherwise(0) for n, c in active_days.items()}
    base = df.select(*keys, day, *measures, *[c.alias(n) for n, c in marks.items()])

    by_key = Window.partitionBy(*keys).orderBy(day)
    first, last = F.lit(window.first), F.lit(window.last)
    fact = F.col(day)
    near_fact = (F.lag(day) if forward else F.lead(day)).over(by_key)
    base = base.withColumn("__near", near_fact)
    near = F.col("__near")
    if forward:
        low = F.greatest(F.date_add(fact, -horizon), F.coalesce(F.date_add(near, 1), first), first)
        high = F.least(F.date_add(fact, -1), last)
    else:
        low = F.greatest(F.date_add(fact, 1), first)
        high = F.least(F.date_add(fact, horizon), F.coalesce(F.date_add(near, -1), last), last)
    gap_days = F.when(low <= high, F.sequence(low, high, F.expr("interval 1 day")))
    no_days = F.array().cast("array<date>")
    dense = base.withColumn(
        "__t", F.explode(F.concat(F.array(fact), F.coalesce(gap_days, no_days)))
    )
    own = F.col("__t") == fact
    daily = dense.select(
        *keys,
        F.col("__t").alias(day),
        F.datediff("__t", F.lit(_UNIX_DAY)).alias(_DAY_NO),
        *[F.when(own, F.col(m)).alias(m) for m in measures],
        *[F.when(own, F.col(n)).otherwise(0).alias(n) for n in marks],
    )

    order = Window.partitionBy(*keys).orderBy(_DAY_NO)
    out: list[Column] = [F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures]
    for band in bands:
        frame = (
            order.rangeBetween(band.near, band.far)
            if forward
            else order.rangeBetween(-band.far, -band.near)
        )
        out += [F.coalesce(F.sum(m).over(frame), F.lit(0)).alias(f"{m}_{band.name}") for m in measures]
        out += [
            F.coalesce(F.sum(f"__act_{n}").over(frame), F.lit(0)).cast("bigint").alias(f"{n}_{band.name}")
            for n in active_days
        ]
    rolled = daily.select(*keys, day, *out)
    return rolled.where(F.col(day).between(first, last))


def repeat_entities(
    df: DataFrame, day: str, entity: str, span: int = 7, out: str = "n_repeat"
) -> DataFrame:
    """Per day with events: entities seen on more than one day of ``[T - span + 1, T]``.

    After reduction to distinct (entity, day), an entity qualifies on day T exactly
    when its latest two days up to T both lie in the span. Between one of its days and
    the next that is one interval, so every entity contributes disjoint intervals and
    the per-day counts are plain counts.
    """
    days = df.where(F.col(entity).isNotNull()).select(entity, day).distinct()
    by_entity = Window.partitionBy(entity).orderBy(day)
    reach = F.date_add(F.lag(day).over(by_entity), span - 1)
    until = F.least(reach, F.date_add(F.lead(day).over(by_entity), -1))  # no next day: reach
    hits = (
        days.select(day, reach.alias("__reach"), until.alias("__until"))
        .where((F.col("__reach") >= F.col(day)) & (F.col("__until") >= F.col(day)))
        .select(F.explode(F.sequence(F.col(day), F.col("__until"), F.expr("interval 1 day"))).alias(day))
        .groupBy(day)
        .agg(F.count(F.lit(1)).alias(out))
    )
    event_days = df.select(day).distinct()
    return event_days.join(hits, day, "left").select(day, F.coalesce(out, F.lit(0)).alias(out))
