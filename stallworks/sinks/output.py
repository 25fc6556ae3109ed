"""Plain result files and value clean-up before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.values import finite_or_null


def normalise_for_sink(df: DataFrame) -> DataFrame:
    """Decimals as doubles, NaN and infinities as null; other columns unchanged."""
    exact = (T.DecimalType, T.DoubleType, T.FloatType)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, exact)]
    return df.withColumns({n: finite_or_null(n) for n in names})


def write_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", separator).option("escape", '"').csv(path)


def labelled(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Output names only at the very end of a plan."""
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in df.columns])
