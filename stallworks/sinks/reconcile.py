"""Source rows against written rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.reshape import union_all


def reconcile(routes: dict[str, tuple[DataFrame, DataFrame]], total: bool = True) -> DataFrame:
    """Per route: rows of the source, rows of the target, difference; plus a total row."""
    counts = []
    for name, (source, target) in routes.items():
        for side, df in (("source_rows", source), ("written_rows", target)):
            n = df.agg(F.count(F.lit(1)).alias("n"))
            counts.append(n.select(F.lit(name).alias("route"), F.lit(side).alias("side"), "n"))
    per_side = union_all(counts)
    if total:
        per_side = per_side.withColumn("route", F.explode(F.array(F.col("route"), F.lit("total"))))
    side = lambda s: F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0))
    result = per_side.groupBy("route").agg(
        side("source_rows").alias("source_rows"), side("written_rows").alias("written_rows")
    )
    return result.withColumn("delta", F.col("source_rows") - F.col("written_rows"))
