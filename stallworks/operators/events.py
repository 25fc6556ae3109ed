"""Write and upload event logs, where the latest event of a key counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .ranking import one_per_key


def latest_status(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last event per key."""
    return one_per_key(events, keys, order, last=True)


def current_failures(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], status: str, failed: str = "failed"
) -> DataFrame:
    """Keys whose last event is a failure."""
    return latest_status(events, keys, order).where(F.col(status) == failed)


def status_summary(events: DataFrame, kind: str, status: str) -> DataFrame:
    """Events per kind and status; a missing status counts as 'unknown'."""
    label = F.concat_ws("_", F.col(kind), F.coalesce(F.col(status), F.lit("unknown")))
    return events.groupBy(label.alias("kind_status")).agg(F.count(F.lit(1)).alias("n"))
