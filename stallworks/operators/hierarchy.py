"""Flattening a parent-id hierarchy of fixed depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def flatten_hierarchy(
    df: DataFrame, levels: Sequence[str], id_col: str, parent_col: str, level_col: str, name_col: str
) -> DataFrame:
    """Add ``<level>_id`` and ``<level>_name`` of every ancestor and of the row itself.

    ``levels`` names the levels from the root down; ``level_col`` holds their position.
    The walk goes down: the rows of a level join the finished paths of the level above,
    so each row takes part in one join, whatever the depth. A row whose parent is not
    one level above it keeps nulls from there upwards.
    """
    done: list[DataFrame] = []
    above: DataFrame | None = None
    for depth, level in enumerate(levels):
        rows = df.where(F.col(level_col) == depth).withColumns(
            {f"{level}_id": F.col(id_col), f"{level}_name": F.col(name_col)}
        )
        upper = [f"{l}_{part}" for l in levels[:depth] for part in ("id", "name")]
        if above is not None:
            paths = above.select(F.col(id_col).alias("__up"), *upper)
            rows = rows.join(paths, F.col(parent_col) == F.col("__up"), "left").drop("__up")
        done.append(rows)
        above = rows
    result = done[0]
    for rows in done[1:]:
        result = result.unionByName(rows, allowMissingColumns=True)
    return result
