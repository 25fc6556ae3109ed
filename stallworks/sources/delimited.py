"""Delimited text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import parse_day

#: Separator by file suffix.
SEPARATORS = {"csv": ",", "tsv": "\t", "txt": "\t"}


def separator_for(path: str) -> str:
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in SEPARATORS:
        raise ValueError(f"cannot infer a delimiter from {path!r}")
    return SEPARATORS[suffix]


def _lines_after(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """Lines of text files without the first ``skip`` of each file.

    A row's number counts on within its input split, so a file's first lines are those
    with the smallest numbers in the split at its beginning: one row for each file.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
    )
    heads = lines.where("block = 0").groupBy("file").agg(F.min("number").alias("first"))
    numbered = lines.join(heads, "file", "left")
    inside = (F.col("block") == 0) & (F.col("number") < F.col("first") + skip)
    return numbered.where(~inside).select("value")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    separator: str | None = None,
    header: bool = True,
    columns: Sequence[str] | None = None,
    day_columns: Sequence[str] = (),
    encoding: str = "UTF-8",
    quote: str = '"',
    multi_line: bool = False,
    skip_rows: int = 0,
    unreadable: str | None = None,
) -> DataFrame:
    """Typed scan of delimited text. The schema is given, so no inference pass runs.

    Files stay splittable unless quoted values may span lines (``multi_line``).
    ``skip_rows`` leaves out as many lines at the beginning of each file, above the header.
    A cell that cannot be read is null; ``unreadable`` names a column that then has the
    whole line, and null elsewhere (see ``count_unreadable``).
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = T.StructType([*schema.fields, *([T.StructField(unreadable, T.StringType())] if unreadable else [])])
    options = {
        "sep": separator or separator_for(path),
        "quote": quote,
        "escape": quote,
        "mode": "PERMISSIVE",
        **({"columnNameOfCorruptRecord": unreadable} if unreadable else {}),
    }
    if skip_rows:
        if multi_line or encoding.upper().replace("-", "") != "UTF8":
            raise ValueError("rows can be skipped in UTF-8 files with one record on a line")
        lines = _lines_after(spark, path, skip_rows + (1 if header else 0)).where(F.trim("value") != "")
        df = lines.select(F.from_csv("value", fields.toDDL(), options).alias("r")).select("r.*")
    else:
        reader = spark.read.schema(fields).options(**options)
        df = reader.option("header", header).option("encoding", encoding).option("multiLine", multi_line).csv(path)
    if columns is not None:
        df = df.select(*columns, *([unreadable] if unreadable else []))
    return df.withColumns({c: parse_day(F.col(c)) for c in day_columns if c in df.columns})


def count_unreadable(df: DataFrame, unreadable: str) -> DataFrame:
    """``n_rows, n_unreadable``: lines, and those with a cell that could not be read."""
    # all columns are named, as a line is only parsed for the columns that are asked for
    whole = F.struct(*[F.col(c) for c in df.columns if c != unreadable])
    bad = F.when(F.col(unreadable).isNotNull(), whole)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(bad).alias("n_unreadable"))
