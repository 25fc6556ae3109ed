"""Column types of configuration tables, and write-side coercion."""

from __future__ import annotations

from enum import IntEnum

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .dates import value_to_millis
from .text import attachment_urls, is_truthy
from .values import to_number


class FieldType(IntEnum):
    """Field type codes. A percent is a number with its own display."""

    TEXT = 1
    NUMBER = 2
    SINGLE_SELECT = 3
    MULTI_SELECT = 4
    DATE = 5
    CHECKBOX = 7
    PERSON = 11
    PHONE = 13
    URL = 15
    ATTACHMENT = 17
    SINGLE_LINK = 18
    LOOKUP = 19
    FORMULA = 20
    DUPLEX_LINK = 21
    LOCATION = 22
    GROUP = 23
    STAGE = 24
    CREATED_TIME = 1001
    MODIFIED_TIME = 1002
    CREATED_USER = 1003
    MODIFIED_USER = 1004
    AUTO_NUMBER = 1005


TIME_TYPES = (FieldType.DATE, FieldType.CREATED_TIME, FieldType.MODIFIED_TIME)
USER_TYPES = (FieldType.PERSON, FieldType.CREATED_USER, FieldType.MODIFIED_USER)


def is_blank(c: Column, data_type: T.DataType) -> Column:
    """Null, NaN and blank text all count as missing."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    if isinstance(data_type, T.StringType):
        return c.isNull() | (F.trim(c) == "")
    return c.isNull()


def _texts(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda x: x.cast("string"))
    parts = F.transform(F.split(c.cast("string"), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: F.length(x) > 0)


def coerce_for_write(name: str, data_type: T.DataType, field_type: FieldType) -> Column:
    """The value in the shape its target field stores; null where it cannot be."""
    raw = F.col(name)
    blank = is_blank(raw, data_type)
    if field_type == FieldType.NUMBER:
        value = to_number(raw)
    elif field_type == FieldType.SINGLE_SELECT:
        value = F.struct(raw.cast("string").alias("text"))
    elif field_type == FieldType.MULTI_SELECT:
        value = F.transform(_texts(raw, data_type), lambda x: F.struct(x.alias("text")))
        return F.when(~blank, value).otherwise(F.array().cast("array<struct<text:string>>"))
    elif field_type == FieldType.DATE:
        value = value_to_millis(raw, data_type)
    elif field_type == FieldType.CHECKBOX:
        numeric = isinstance(data_type, (T.NumericType, T.BooleanType))
        value = raw.cast("boolean") if numeric else is_truthy(raw)
    elif field_type == FieldType.PERSON:
        ids = _texts(raw, data_type) if isinstance(data_type, T.ArrayType) else F.array(raw.cast("string"))
        value = F.transform(ids, lambda x: F.struct(x.alias("id")))
    elif field_type == FieldType.URL:
        text = raw.cast("string")
        value = F.struct(text.alias("link"), text.alias("text"))
    elif field_type == FieldType.ATTACHMENT:
        urls = raw if isinstance(data_type, T.ArrayType) else attachment_urls(raw)
        value = F.transform(urls, lambda x: F.struct(x.alias("url")))
    elif field_type == FieldType.TEXT:
        value = raw.cast("string")
    else:
        value = raw
    return F.when(~blank, value)


def coerce_frame(df: DataFrame, mapping: dict[str, tuple[str, FieldType]]) -> DataFrame:
    """Project ``df`` to its target fields: ``{source column: (target field, type)}``."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"missing required columns: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[coerce_for_write(c, types[c], t).alias(target) for c, (target, t) in mapping.items()]
    )


def coercion_issues(df: DataFrame, mapping: dict[str, tuple[str, FieldType]]) -> DataFrame:
    """Per target field, how many present values could not be coerced. One pass."""
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, (c, (_, t)) in enumerate(mapping.items()):
        lost = ~is_blank(F.col(c), types[c]) & coerce_for_write(c, types[c], t).isNull()
        aggs.append(F.count(F.when(lost, 1)).alias(f"n{i}"))
    counts = df.agg(*aggs)
    pairs = ", ".join(f"'{t}', n{i}" for i, (t, _) in enumerate(mapping.values()))
    return counts.selectExpr(f"stack({len(mapping)}, {pairs}) as (field, n_failed)")
