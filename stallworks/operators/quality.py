"""Data-quality checks as an issues table.

All count-like checks of all columns come from one aggregate over the data; nothing
is sampled. Listings of distinct values are cut to their first values per column
after duplicates are gone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.coerce import FieldType, TIME_TYPES
from ..functions.dates import parse_day
from ..functions.text import CHECKBOX_DOMAIN, looks_like_link

ISSUE_SCHEMA = "field string, check string, level string, n bigint, value double"
#: Number displays that stand for a share.
PERCENT_DISPLAYS = ("progress", "percent", "percentage")


@dataclass(frozen=True)
class FieldCheck:
    """A target field to check: its column, type and, for percents, its display."""

    column: str
    field_type: FieldType
    display: str = ""


@dataclass(frozen=True)
class _Rule:
    field: str
    check: str
    level: str
    n: Column
    value: Column
    raised: Column


def missing_columns(df: DataFrame, checks: Sequence[FieldCheck]) -> DataFrame:
    """One CRITICAL row per checked column the data lacks."""
    names = [c.column for c in checks if c.column not in df.columns]
    rows = [(n, "missing_column", "CRITICAL", 1, None) for n in names]
    return df.sparkSession.createDataFrame(rows, ISSUE_SCHEMA)


def _count(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _rules(df: DataFrame, check: FieldCheck, null_limit: float) -> list[_Rule]:
    name, kind = check.column, check.field_type
    col, data_type = F.col(name), df.schema[check.column].dataType
    total, present = F.count(F.lit(1)), F.count(col)
    none = F.lit(None).cast("double")
    out: list[_Rule] = []

    def rule(label: str, level: str, n: Column, raised: Column | None = None, value: Column = none) -> None:
        out.append(_Rule(name, label, level, n, value, n > 0 if raised is None else raised))

    if kind in TIME_TYPES:
        rule("all_null", "WARNING", total - present, (present == 0) & (total > 0))
        if isinstance(data_type, T.StringType):
            rule("unparseable_date", "CRITICAL", _count(col.isNotNull() & parse_day(col).isNull()))
            form = "kind_string"
        elif isinstance(data_type, T.NumericType):
            form = "kind_numeric"
        else:
            form = "kind_datetime"
        rule(form, "INFO", present)
    elif kind == FieldType.NUMBER:
        if not isinstance(data_type, T.NumericType):
            lost = col.isNotNull() & col.cast("string").try_cast("double").isNull()
            rule("not_numeric", "WARNING", _count(lost))
        share = F.try_divide((total - present).cast("double"), total.cast("double"))
        rule("null_share", "WARNING", total - present, share > null_limit, F.round(share, 5))
        if check.display.lower() in PERCENT_DISPLAYS and isinstance(data_type, T.NumericType):
            rule("outside_unit_range", "WARNING", _count((col < 0) | (col > 1)))
    elif kind == FieldType.TEXT:
        length = F.length(col.cast("string"))
        rule("max_length", "INFO", present, present > 0, F.max(length).cast("double"))
        rule("mean_length", "INFO", present, present > 0, F.round(F.avg(length), 4))
    elif kind == FieldType.CHECKBOX and not isinstance(data_type, T.BooleanType):
        rule("checkbox_domain", "WARNING", _count(~col.cast("string").isin(*CHECKBOX_DOMAIN)))
    return out


def check_columns(df: DataFrame, checks: Sequence[FieldCheck], null_limit: float = 0.5) -> DataFrame:
    """Issue rows of every existing column, from one pass over ``df``."""
    rules = [r for c in checks if c.column in df.columns for r in _rules(df, c, null_limit)]
    if not rules:
        return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    issues = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(r.field).alias("field"),
                    F.lit(r.check).alias("check"),
                    F.lit(r.level).alias("level"),
                    r.n.cast("bigint").alias("n"),
                    r.value.alias("value"),
                    F.coalesce(r.raised, F.lit(False)).alias("raised"),
                )
                for r in rules
            ]
        ).alias("issues")
    )
    return issues.select(F.inline("issues")).where("raised").drop("raised")


def select_values(df: DataFrame, columns: Sequence[str], shown: int = 20) -> DataFrame:
    """Per column: number of distinct values and the first ``shown`` of them.

    One unpivot feeds all columns. Counting uses the distinct pairs; the listing ranks
    them, and Spark cuts each column to ``shown`` rows before its shuffle.
    """
    entry = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in columns]
    pairs = df.select(F.inline(F.array(*entry))).where(F.col("v").isNotNull()).distinct()
    counts = pairs.groupBy("field").agg(F.count(F.lit(1)).alias("n_distinct"))
    from .ranking import top_k

    first = top_k(pairs, ["field"], [F.col("v").asc()], shown)
    lists = first.groupBy("field").agg(F.sort_array(F.collect_list("v")).alias("first_values"))
    return counts.join(lists, "field")


def link_like_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, whether some value looks like a link or path, and how many do."""
    items = [
        F.struct(F.lit(c).alias("field"), _count(looks_like_link(c)).alias("n_links")) for c in columns
    ]
    return df.agg(F.array(*items).alias("x")).select(F.inline("x")).withColumn(
        "is_link_like", (F.col("n_links") > 0).cast("int")
    )


def array_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per array column: rows that hold something, and items in total."""
    items = [
        F.struct(
            F.lit(c).alias("field"),
            _count(F.size(c) > 0).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.size(c) > 0, F.size(c))), F.lit(0)).cast("bigint").alias("n_items"),
        )
        for c in columns
    ]
    return df.agg(F.array(*items).alias("x")).select(F.inline("x"))


def infer_field_types(
    df: DataFrame, attachments: Sequence[str] = (), day_field: str | None = None
) -> dict[str, FieldType]:
    """Target field type of every column, from the schema alone."""
    out: dict[str, FieldType] = {}
    for f in df.schema.fields:
        if f.name in attachments:
            out[f.name] = FieldType.ATTACHMENT
        elif f.name == day_field or isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = FieldType.DATE
        elif isinstance(f.dataType, T.BooleanType):
            out[f.name] = FieldType.CHECKBOX
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = FieldType.NUMBER
        else:
            out[f.name] = FieldType.TEXT
    return out


@dataclass(frozen=True)
class Coverage:
    """How well source columns map to a target's fields."""

    mapping: dict[str, tuple[str, FieldType]]
    coverage: float
    unmatched: list[str]
    to_create: list[str]
    n_same_name: int
    n_columns: int

    def accept(self, threshold: float = 0.9) -> bool:
        return self.coverage >= threshold


def parse_override(item: str) -> tuple[str, str, FieldType | None]:
    """``source:target[:TYPE]``."""
    parts = [p.strip() for p in item.split(":")]
    if len(parts) not in (2, 3) or not parts[0] or not parts[1]:
        raise ValueError(f"invalid field override {item!r}, use source:target[:type]")
    kind = FieldType[parts[2].upper()] if len(parts) == 3 else None
    return parts[0], parts[1], kind


def map_to_target(
    df: DataFrame,
    target: dict[str, FieldType] | None,
    overrides: Sequence[str] = (),
    create_missing: bool = False,
    attachments: Sequence[str] = (),
    day_field: str | None = None,
    backup_suffix: str = "_bak",
) -> Coverage:
    """Match columns to target fields. ``target`` None means the table is yet to be made."""
    renames = {s: (t, k) for s, t, k in map(parse_override, overrides)}
    inferred = infer_field_types(df, attachments, day_field)
    known = target or {}
    columns = [c for c in df.columns if c != "row_key"]
    own = [c for c in columns if not c.endswith(backup_suffix)]
    same = sum(c in known for c in own)
    mapping: dict[str, tuple[str, FieldType]] = {}
    unmatched: list[str] = []
    to_create: list[str] = []
    for c in columns:
        name, kind = renames.get(c, (c, None))
        absent = target is not None and name not in known
        if absent and not create_missing:
            unmatched.append(c)
            continue
        if absent and kind is None:
            to_create.append(name)
        mapping[c] = (name, kind or known.get(name) or inferred[c])
    return Coverage(mapping, 1.0 if not own else same / len(own), unmatched, to_create, same, len(own))
