"""Configuration snapshots: goods on trial and the region tree."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ...functions.text import first_part, strip_digits
from ...functions.values import any_positive, first_match, flag, nz, presence, price_net_of_rate
from ...operators.hierarchy import flatten_hierarchy
from ...sources.tables import latest_snapshot

#: Region levels from the root down.
REGION_LEVELS = ("province", "city", "county", "street", "address")
EXTRA_ATTRIBUTES = ("sku_grade", "producing_area", "packaging", "single_size", "color_code", "sku_quantity")


def goods_config(
    goods: DataFrame,
    extra: DataFrame,
    trial_skus: Sequence[int],
    trial_from: date,
    categories: Sequence[str] | None = None,
    prices: Sequence[str] = ("unit_price", "standard_price"),
) -> DataFrame:
    """Goods as of the day before the newest snapshot, with supply prices net of commission: 26 columns.

    ``trial_from`` starts the trial period of ``trial_skus``.
    """
    rows = latest_snapshot(goods, "dt", 1).where(any_positive("is_up_today", "is_sku_valid"))
    if categories is not None:
        rows = rows.where(F.col("back_category").isin(list(categories)))
    attributes = latest_snapshot(extra, "dt", 1).drop("dt")
    joined = rows.join(attributes, "sku_id", "left")
    on_trial = F.col("sku_id").isin(list(trial_skus))
    return joined.select(
        "dt", "mall_id", "sku_id", "sku_code", "sku_name", *EXTRA_ATTRIBUTES, "merchant_id", "merchant_name", "merchant_type",
        "back_category_id", "back_category", "net_weight", "gross_weight",
        *[F.col(p).cast("double").alias(p) for p in prices],
        F.col("commission_rate").cast("double").alias("commission_rate"),
        *[price_net_of_rate(p, "commission_rate").alias(f"supply_{p}") for p in prices],
        nz("is_up_today").alias("is_up_today"),
        flag(on_trial & (F.col("dt") >= F.lit(trial_from))).alias("in_trial_period"),
        flag(on_trial).alias("is_trial_sku"),
    )


def region_config(
    regions: DataFrame,
    agent_grids: DataFrame,
    agent_label: str,
    self_label: str,
    keep_level: str = "county",
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Regions of one level as of the newest snapshot, with their ancestors and who operates them.

    A county is agent-run when its name without digits equals the first part of an
    active agent grid's name. That list is reduced to distinct names, so several grids
    in a county do not repeat it.
    """
    used = latest_snapshot(regions, "dt").where(F.col("used") == 1)
    flat = flatten_hierarchy(used, REGION_LEVELS, "id", "parent_id", "level", "name")
    flat = flat.withColumn("clean_name", strip_digits("name"))
    active = agent_grids.where(F.col("status") == 1).select(
        first_part("grid_name").alias("clean_name"), F.lit(1).alias("agent")
    ).distinct()
    level_name = first_match(
        [(F.col("level") == i, name) for i, name in enumerate(REGION_LEVELS)], "unknown"
    )
    rows = flat.withColumn("level_name", level_name).where(F.col("level_name") == keep_level)
    if excluded:
        rows = rows.where(~F.col("name").isin(list(excluded)))
    rows = rows.join(active, "clean_name", "left")
    paths = [f"{l}_{p}" for l in REGION_LEVELS for p in ("id", "name")]
    return rows.select(
        "dt", F.col("id").alias("region_id"), F.col("name").alias("region_name"), "clean_name", F.col("alias").alias("region_alias"),
        *paths, "longitude", "latitude", "parent_id", F.col("used").alias("is_valid"), "level", "level_name",
        presence("agent", agent_label, self_label).alias("operate_type"),
    )
