"""Upserts, conditional deletes and additive schema changes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.predicates import Condition, predicate
from ..session import scratch_path
from .partitions import drop_days, drop_folder, overwrite_days, require_days


def upsert(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    mode: str = "merge",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Table after inserting ``new``, which holds one row per key; a null key equals no key.

    merge:  a row whose key exists replaces it, or only its ``columns``
    ignore: a row whose key exists is left out
    """
    keys = list(keys)
    if mode == "ignore":
        fresh = new.join(old.select(*keys), keys, "left_anti")
        return old.unionByName(fresh, allowMissingColumns=True)
    if mode != "merge":
        raise ValueError("mode is 'merge' or 'ignore'")
    kept = old.join(new.select(*keys), keys, "left_anti")
    if columns is not None:
        untouched = [c for c in old.columns if c not in keys and c not in columns]
        new = new.select(*keys, *columns).join(old.select(*keys, *untouched), keys, "left")
    return kept.unionByName(new.select(*[c for c in old.columns if c in new.columns]), allowMissingColumns=True)


def delete_where(df: DataFrame, conditions: list[Condition], conjunction: str = "and") -> DataFrame:
    """Rows that no deletion condition holds for; unknown is not a match."""
    return df.where(~predicate(conditions, conjunction))


@contextmanager
def staged(rows: DataFrame, label: str) -> Iterator[DataFrame]:
    """``rows`` as a table in the shared folder, removed again whatever happens."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        drop_folder(spark, path)


def _rewrite(path: str, day: str, days: list, rows: DataFrame) -> None:
    """Replace the named days by ``rows``, which were derived from the same table.

    The rows are staged first: the target is read completely before any of its files goes
    away. Days that are written are replaced before emptied ones are dropped; a run that
    breaks off in between leaves emptied days, which a second run drops.
    """
    with staged(rows, "stage") as held:
        left = set(_days_of(held, day))
        overwrite_days(held, path, day)
        drop_days(held.sparkSession, path, day, [d for d in days if d not in left])


def _days_of(df: DataFrame, day: str) -> list:
    """Distinct days, null among them: one row per calendar day at most."""
    require_days(df, day)
    return [r[0] for r in df.select(day).distinct().collect()]


def _in_days(day: str, days: list) -> Column:
    """Rows of the listed days; null is a day of its own."""
    known = F.coalesce(F.col(day).isin([d for d in days if d is not None]), F.lit(False))
    return known | F.col(day).isNull() if None in days else known


def upsert_into(
    new: DataFrame,
    path: str,
    day: str,
    keys: Sequence[str],
    mode: str = "merge",
    columns: Sequence[str] | None = None,
) -> None:
    """Upsert into a day-partitioned table; only the days of ``new`` are rewritten.

    Rows without a day form a partition of their own; as null equals no key, such rows are
    added and none of them is replaced. Two rows of ``new`` with one key are refused: which
    of them should win is not known here.
    """
    if day not in keys:
        raise ValueError("the partition day must be part of the key")
    spark = new.sparkSession
    require_days(new, day)
    old = spark.read.parquet(path)
    with staged(new.select(*[c for c in old.columns if c in new.columns]), "incoming") as rows:
        twice = rows.dropna(subset=list(keys)).groupBy(*keys).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"two new rows have the key {[twice[0][k] for k in keys]}")
        days = _days_of(rows, day)
        if days:
            touched = old.where(_in_days(day, days))
            _rewrite(path, day, days, upsert(touched, rows, keys, mode, columns))


def delete_from(
    spark: SparkSession, path: str, day: str, conditions: list[Condition], conjunction: str = "and"
) -> None:
    """Delete matching rows of a day-partitioned table; only days with a match are rewritten."""
    table = spark.read.parquet(path)
    doomed: Column = predicate(conditions, conjunction)
    days = _days_of(table.where(doomed), day)
    if days:
        _rewrite(path, day, days, table.where(_in_days(day, days)).where(~doomed))


def missing_fields(target: Sequence[str], incoming: DataFrame) -> list[tuple[str, str]]:
    """Fields a target lacks, with their types."""
    return [(f.name, f.dataType.simpleString()) for f in incoming.schema.fields if f.name not in target]


def append_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append; new columns are added, old rows read null there."""
    return old.unionByName(new, allowMissingColumns=True)


def append_into(new: DataFrame, path: str, day: str) -> list[tuple[str, str]]:
    """Append to a stored day-partitioned table, widened by the columns it lacks.

    Files already written stay as they are; ``read_evolved`` gives their rows null in a
    column that came later. Returns the added fields.
    """
    require_days(new, day)
    added = missing_fields(read_evolved(new.sparkSession, path).columns, new)
    new.hint("rebalance", F.col(day)).write.mode("append").partitionBy(day).parquet(path)
    return added


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files may have different columns: the union of them."""
    return spark.read.option("mergeSchema", True).parquet(path)


def retry_only(df: DataFrame, failed: DataFrame, key: str = "row_key") -> DataFrame:
    """Rows whose key is among the failed ones, for a second run."""
    return df.join(failed.select(key), key, "left_semi")
