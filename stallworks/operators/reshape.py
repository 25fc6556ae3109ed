"""Column-level reshaping: unpivot, projection, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def unpivot_flags(
    df: DataFrame, ids: Sequence[str], flags: dict[str, str], label: str, mark: str, yes: str = "是"
) -> DataFrame:
    """Wide yes/no columns to one row per (ids, label) that is set.

    A text flag is set when it reads ``yes``, a numeric one when it is 1.
    """
    present = {c: l for c, l in flags.items() if c in df.columns}
    if not present:
        return df.select(*ids, F.lit("").alias(label), F.lit(1).alias(mark)).where(F.lit(False))
    checks = []
    for c, l in present.items():
        text = isinstance(df.schema[c].dataType, T.StringType)
        is_set = (F.trim(F.col(c)) == yes) if text else (F.col(c) == 1)
        checks.append(F.when(is_set, F.lit(l)))
    labels = F.array_compact(F.array(*checks))
    return df.select(*ids, F.explode(labels).alias(label), F.lit(1).alias(mark))


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ordered projection on those of the columns that exist."""
    return df.select(*[c for c in columns if c in df.columns])


def drop_internal(df: DataFrame, prefix: str = "_") -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def pad_columns(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Add the schema's missing columns as nulls, or refuse when ``strict``."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    if missing and strict:
        raise ValueError(f"missing columns: {[f.name for f in missing]}")
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def relabel_columns(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Rename to output labels and keep only those, in the order given."""
    return df.select(*[F.col(c).alias(l) for c, l in labels.items()])


def backup_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_bak") -> DataFrame:
    """Text copies of columns, '' for null."""
    return df.withColumns(
        {c + suffix: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns if c in df.columns}
    )


def row_key(columns: Sequence[str], checked: bool = True) -> Column:
    """Parts joined with ``_``; a row with a missing leading part fails the job."""
    key = F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    if not checked:
        return key
    lead = F.col(columns[0]).cast("string")
    bad = lead.isNull() | (F.trim(lead) == "") | (F.lower(lead) == "nan")
    message = F.lit(f"empty row key over {list(columns)}")
    return F.when(bad, F.raise_error(message).cast("string")).otherwise(key)


def with_row_key(df: DataFrame, columns: Sequence[str], name: str = "row_key") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing row key columns {missing}")
    return df.withColumn(name, row_key(columns))


def scale_columns(df: DataFrame, columns: Sequence[str], factor: float = 100.0) -> DataFrame:
    """Rates as percentages for presentation."""
    return df.withColumns({c: F.col(c) * F.lit(factor) for c in columns if c in df.columns})


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns missing on a side are null."""
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def whole_rows(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows as a unit: whoever reads some of the columns reads all of them.

    Branches of a plan that read different columns of a join each shuffle its sides anew.
    Above this they have the same plan below, so Spark runs it, and its exchanges, once. Name
    the columns that are needed only. ``keys`` are those by which the rows lie; they still do.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, F.inline(F.array(F.struct(*rest))))


def on_two_days(df: DataFrame, own: Column, other: Column, day: str = "dt", mark: str = "on_other_day") -> DataFrame:
    """Each row on its own day and, where ``other`` is not null, once more on that one.

    For measures that are reported on two calendars, such as a refund on the day of its
    order and on the day it was paid: both are then added up in one aggregate. ``mark``
    tells the copies apart; a copy on the same day stays a copy.
    """
    copy = lambda d, second: F.struct(d.alias("day"), F.lit(second).alias("second"))
    days = F.array_compact(F.array(copy(own, False), F.when(other.isNotNull(), copy(other, True))))
    return df.withColumn("__copy", F.explode(days)).withColumns({day: F.col("__copy.day"), mark: F.col("__copy.second")}).drop("__copy")
