"""Trial pricing plan: products × regions with the rate or fee that applies."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ...functions.adjust import adjustment_direction
from ...functions.dates import covers
from ...functions.text import has
from ...operators.joins import grid_product, override_rate
from ...operators.ranking import one_per_key
from ...operators.reshape import scale_columns
from ...sources.tables import scan_day


@dataclass(frozen=True)
class PricingLabels:
    """Tags of the operation type and output labels."""

    self_tag: str = "自营"
    agent_tag: str = "代理"
    down: str = "降价"
    same: str = "不变"
    up: str = "涨价"
    status: str = "启用"


def trial_products(goods: DataFrame, trial_goods: DataFrame, day: date) -> DataFrame:
    """Yesterday's goods that are on trial today; the base rate is the trial's."""
    trial = scan_day(trial_goods, "dt", day).select("goods_id", "base_rate")
    return scan_day(goods, "dt", day, lag=1).drop("base_rate", "dt").join(trial, "goods_id")


def active_rates(rates: DataFrame, day: date, order: str) -> DataFrame:
    """Rates valid on the day, the last one per product and city."""
    valid = rates.where(covers("start_day", "end_day", day)).select(
        F.col("goods_id").try_cast("bigint").alias("goods_id"),
        F.col("city_id").try_cast("bigint").alias("city_id"),
        F.coalesce("trial_group", F.lit("")).alias("trial_group"),
        "self_rate", "agent_rate", order,
    ).dropna(subset=["goods_id", "city_id"])
    return one_per_key(valid, ["goods_id", "city_id"], [order]).drop(order)


def with_fee(regions: DataFrame, logistics: DataFrame, day: date) -> DataFrame:
    """County fee where the city's map names the county, else the city fee, else null."""
    fees = scan_day(logistics, "dt", day).select("city_id", "fee_rate", "county_fee_json")
    joined = regions.join(fees, "city_id", "left")
    fee = override_rate(F.col("county_fee_json"), F.col("county_id"), F.col("fee_rate"))
    return joined.withColumn("fee", fee).drop("fee_rate", "county_fee_json")


def pricing_plan(
    t: Mapping[str, DataFrame],
    day: date,
    labels: PricingLabels = PricingLabels(),
    rate_order: str = "seq",
    percent: bool = True,
) -> DataFrame:
    """Fixed commission ratio on trial, fixed amount elsewhere, with its direction.

    A pair without a rate and without a fee has no price and is left out. Rates are looked
    up for products × cities, a small grid; the large one, products × regions, comes out of
    the last join and is never shuffled itself. A region without a city has neither rate
    nor fee.
    """
    products = trial_products(t["goods"], t["trial_goods"], day)
    regions = with_fee(scan_day(t["county"], "dt", day).drop("dt"), t["logistics"], day)
    rates = active_rates(t["trial_rate"], day, rate_order)
    cities = regions.select("city_id").dropna().distinct()
    offers = grid_product(products, cities).join(rates, ["goods_id", "city_id"], "left")
    grid = regions.join(offers, "city_id")
    rate = F.when(has("operation_type", labels.self_tag), F.col("self_rate")).when(
        has("operation_type", labels.agent_tag), F.col("agent_rate")
    )
    priced = grid.withColumn("rate", rate)
    on_trial = F.col("rate").isNotNull()
    diff = F.col("rate") - F.col("base_rate")
    plan = priced.select(
        "region_id", "region_name", "goods_code", "goods_name",
        adjustment_direction(on_trial, diff, labels.down, labels.same, labels.up).alias("direction"),
        F.lit(None).cast("double").alias("adjustment"),
        F.lit(labels.status).alias("status"),
        F.when(on_trial, F.abs(diff)).alias("ratio"),
        F.when(~on_trial, F.col("fee") * F.col("gross_weight")).alias("value"),
        "goods_id", "category",
        F.when(on_trial, 1).otherwise(0).alias("is_trial"),
        F.when(on_trial, F.col("trial_group")).otherwise("").alias("trial_group"),
    ).dropna(how="all", subset=["ratio", "value"])
    return scale_columns(plan, ["ratio"]) if percent else plan
