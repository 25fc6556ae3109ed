"""Day partitions of a table on the file system."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def partition_days(spark: SparkSession, path: str, column: str) -> list[date]:
    """Days that have a partition folder; a listing, no data is read."""
    fs, root = _filesystem(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    prefix = f"{column}="
    texts = [n[len(prefix):] for n in names if n.startswith(prefix)]
    return sorted(date.fromisoformat(t) for t in texts if not t.startswith("__"))


#: Fixed value: the folder of rows whose partition column is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def require_days(df: DataFrame, column: str) -> None:
    """Refuse a partition column that is not a calendar day: its values would not be bounded."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.DateType):
        raise TypeError(f"{column!r} must be a date to partition by, not {kind.simpleString()}")


def drop_days(spark: SparkSession, path: str, column: str, days: Iterable[date | None]) -> None:
    """Remove the folders of the days; None stands for rows without a day."""
    for day in days:
        drop_folder(spark, f"{path.rstrip('/')}/{column}={NULL_FOLDER if day is None else day.isoformat()}")


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, root = _filesystem(spark, path)
    fs.delete(root, True)


def overwrite_days(df: DataFrame, path: str, column: str) -> None:
    """Replace exactly the day partitions that ``df`` has rows for.

    The rebalance hint gathers a day into few files and lets AQE split a day that is
    too large for one task.
    """
    (
        df.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
