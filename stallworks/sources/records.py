"""Configuration-table records: ``record_id`` plus a JSON object of field values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.coerce import FieldType, TIME_TYPES, USER_TYPES
from ..functions.dates import SECONDS_LIMIT, millis_to_timestamp
from ..functions.values import to_number


def _object_text(value: Column) -> Column:
    """``text`` of a JSON object, or the plain value."""
    return F.when(value.startswith("{"), F.get_json_object(value, "$.text")).otherwise(value)


def _items(value: Column, key: str) -> Column:
    parsed = F.from_json(value, f"array<struct<{key}:string>>")
    return F.transform(parsed, lambda x: x[key])


def normalise(value: Column, field_type: FieldType | None) -> Column:
    """One field's raw JSON text as the Spark type its field type stands for."""
    if field_type is None:
        return normalise_untyped(value)
    if field_type in TIME_TYPES:
        return millis_to_timestamp(value.try_cast("double").cast("bigint"))
    if field_type == FieldType.SINGLE_SELECT:
        return _object_text(value)
    if field_type == FieldType.MULTI_SELECT:
        return _items(value, "text")
    if field_type in USER_TYPES:
        return _items(value, "id")
    if field_type == FieldType.NUMBER:
        return to_number(value)
    if field_type == FieldType.CHECKBOX:
        return value.try_cast("boolean")
    return value


def normalise_untyped(value: Column) -> Column:
    """Best guess by shape, as text: millisecond epochs, objects and lists with labels."""
    number = value.try_cast("double")
    stamp = F.date_format(millis_to_timestamp(number.cast("bigint")), "yyyy-MM-dd HH:mm:ss")
    is_list = value.startswith("[{")
    texts, ids = _items(value, "text"), _items(value, "id")
    labels = F.when(F.element_at(texts, 1).isNotNull(), F.to_json(texts)).when(
        F.element_at(ids, 1).isNotNull(), F.to_json(ids)
    )
    return (
        F.when(number > SECONDS_LIMIT, stamp)
        .when(value.startswith("{"), F.coalesce(F.get_json_object(value, "$.text"), value))
        .when(is_list, F.coalesce(F.when(F.size(texts) > 0, labels), value))
        .otherwise(value)
    )


def extract_records(
    df: DataFrame,
    field_types: dict[str, FieldType | None],
    fields_column: str = "fields",
    id_column: str = "record_id",
) -> DataFrame:
    """Records to a typed table. The JSON object is parsed once per record."""
    parsed = df.select(
        F.col(id_column).alias("_record_id"),
        F.from_json(F.col(fields_column), "map<string,string>").alias("_f"),
    )
    columns = [
        normalise(F.try_element_at("_f", F.lit(name)), kind).alias(name)
        for name, kind in field_types.items()
    ]
    return parsed.select("_record_id", *columns)
