"""Aggregates of a regional commission trial: wide table, rate audit, weekly alerts, power inputs.

Configuration tables (stages, design, rates, goods) have a row per stage, region, rate or
sku; facts are order items. Sums are of decimals, so they do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ...functions.values import flag, first_match, raw_ratio
from ...operators.calendar import WEEK, asof_lookup
from ...params import DateWindow
from ...sources.tables import scan_window


#: Days of a calendar that are sent to all executors, at most; longer ones are joined by a shuffle.
MAX_SENT_DAYS = 50_000


@dataclass(frozen=True)
class TrialRules:
    """Thresholds of the trial. Fixed values are marked."""

    #: Deviations, the rate of self-run regions and how near counts as that rate.
    max_deviation: float = 0.005
    self_rate: float = 0.075
    self_rate_margin: float = 0.0005
    max_swing: float = 0.05
    #: The power formula's factors and the bound on correlated goods.
    cv_factor: float = 1.5
    z_square: float = 7.84
    effect_square: float = 0.01
    cities_per_group: int = 2
    max_pair_correlation: float = 0.5
    least_weeks: int = 3
    #: Per stage and measure, the falls that turn a week yellow and red.
    falls: Mapping[str, Mapping[str, tuple[float, float]]] = field(
        default_factory=lambda: {"effect": {"order_count": (-0.10, -0.15), "active_store_count": (-0.05, -0.10)}}
    )
    agent_type: str = "agent"
    outside: str = "outside"


def city_design(design: DataFrame) -> DataFrame:
    """Regions with their city unit; ``city_type`` is the unit's own type of regions."""
    whole = Window.partitionBy("city_unit")
    return design.withColumn("city_type", F.max("region_type").over(whole))


def trial_rows(facts: DataFrame, design: DataFrame, skus: Sequence[object], window: DateWindow) -> DataFrame:
    """Valid order items of trial goods in trial regions, with their city unit."""
    rows = scan_window(facts, "dt", window).where((F.col("is_valid") == 1) & F.col("sku_id").isin(list(skus)))
    inside = city_design(design).where("in_trial = 1")
    return rows.join(inside.drop("in_trial"), "region_id")


def stage_days(calendar: DataFrame, window: DateWindow, *attributes: str) -> DataFrame:
    """The stage of each day of a window. A day has one row at most, which bounds the rows to send."""
    days = scan_window(calendar, "day", window).select(F.col("day").alias("dt"), "stage", *attributes)
    return F.broadcast(days) if window.n_days <= MAX_SENT_DAYS else days


def wide_table(
    facts: DataFrame, calendar: DataFrame, design: DataFrame, rates: DataFrame, goods: DataFrame,
    skus: Sequence[object], window: DateWindow,
) -> DataFrame:
    """Measures at the grain of each stage: days by type of region, else periods by sku.

    Rows of ``level`` 'city' add a period's skus up and count a store once, whatever it
    bought; rows of level 'sku' count the stores of one sku. A day finds its stage by its
    calendar row, so the lookup is an equi-join.

    Plan: the facts move once, to the items' keys; distinct items and, from the partial
    results per store, distinct stores at both levels come out of grouping sets.
    """
    rows = trial_rows(facts, design, skus, window).join(stage_days(calendar, window, "grain", "period_first"), "dt").withColumn(
        "region_type", F.when(F.col("grain") == "day", F.col("region_type")).otherwise(F.col("city_type"))
    )
    keys = ["stage", "grain", "period_first", "city_unit", "region_type", "trial_group"]
    missing = F.col("ordered_num") - F.col("delivered_num")
    sums = {
        "gmv": F.col("delivered_amt"),
        "commission_amount": F.col("commission_amt"),
        "stockout_num": F.greatest(missing, F.lit(0)),
        "__price": F.col("list_price"),
        "__priced": flag(F.col("list_price").isNotNull()).cast("bigint"),
    }
    item = [*keys, "store_id", "order_item_id"]
    items = rows.repartition(*item).groupBy(*item, "sku_id").agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    first = F.row_number().over(Window.partitionBy(*item).orderBy("sku_id")) == 1
    items = items.withColumns({"__all": F.lit(1), "__first": flag(first)})
    store = [*keys, "store_id"]
    stores = items.groupingSets([[*store, "sku_id"], store], *store, "sku_id").agg(
        F.grouping("sku_id").alias("__city"), *[F.sum(n).alias(n) for n in (*sums, "__all", "__first")]
    )
    stores = stores.where((F.col("__city") == 1) | (F.col("grain") != "day"))
    on_city = F.col("__city") == 1
    wide = stores.groupBy(*keys, "__city", "sku_id").agg(
        F.sum(F.when(on_city, F.col("__first")).otherwise(F.col("__all"))).alias("order_count"),
        F.count(F.lit(1)).alias("active_store_count"),
        *[F.sum(n).alias(n) for n in sums],
    )
    rate = raw_ratio("commission_amount", "gmv")
    periods = calendar.select("stage", "period_first", "stage_week", "is_complete_week", "trading_days").distinct()
    target = rates.select("stage", "trial_group", "region_type", F.col("rate").alias("target_r0"))
    return (
        wide.join(periods, ["stage", "period_first"])
        .join(target, ["stage", "trial_group", "region_type"], "left")
        .join(goods, "sku_id", "left")
        .select(
            F.when(on_city, "city").otherwise("sku").alias("level"),
            "stage", "stage_week", "period_first", "is_complete_week", "trading_days",
            "city_unit", "region_type", "trial_group", "sku_id", "sku_origin", "sku_grade", "sku_weight_spec",
            "order_count", "active_store_count",
            F.col("gmv").cast("double").alias("gmv"),
            F.col("commission_amount").cast("double").alias("commission_amount"),
            F.col("stockout_num").cast("double").alias("stockout_num"),
            F.round(rate, 6).alias("commission_rate"),
            F.round(raw_ratio("__price", "__priced") * (F.lit(1.0) - rate), 4).alias("supply_price"),
            "target_r0",
        )
    )


def week_alerts(wide: DataFrame, rules: TrialRules) -> DataFrame:
    """Each week of a city and sku against its last complete week before.

    Weeks without rows are no base, nor are incomplete ones; an incomplete week is GRAY, a
    week without a base NONE, and otherwise the worse of the two measures' colours counts.
    """
    weeks = wide.where((F.col("level") == "sku") & F.col("stage_week").isNotNull())
    earlier = (
        Window.partitionBy("stage", "city_unit", "sku_id").orderBy("period_first").rowsBetween(Window.unboundedPreceding, -1)
    )
    complete = F.col("is_complete_week")
    base = F.last(
        F.when(complete, F.struct("period_first", "order_count", "active_store_count")), ignorenulls=True
    ).over(earlier)
    rows = weeks.withColumn("__base", base)
    judged = complete & F.col("__base").isNotNull()
    change = {
        m: F.when(judged, F.round(raw_ratio(m, F.col(f"__base.{m}")) - 1, 6)) for m in ("order_count", "active_store_count")
    }
    rows = rows.withColumns({f"{m}_wow": c for m, c in change.items()})

    def falls_below(which: int) -> Column:
        hits = [
            (F.col("stage") == stage) & (F.col(f"{m}_wow") < bounds[which])
            for stage, measures in rules.falls.items()
            for m, bounds in measures.items()
        ]
        met = F.lit(False)
        for hit in hits:
            met = met | F.coalesce(hit, F.lit(False))
        return met

    colour = first_match(
        [(~complete, "GRAY"), (F.col("__base").isNull(), "NONE"), (falls_below(1), "RED"), (falls_below(0), "YELLOW")], "GREEN"
    )
    return rows.select(
        "stage", "stage_week", "period_first", "city_unit", "trial_group", "sku_id", "is_complete_week", "trading_days",
        "order_count", "active_store_count", "stockout_num",
        F.col("__base.period_first").alias("base_first"), "order_count_wow", "active_store_count_wow",
        colour.alias("alert"),
    )


def rate_audit(
    active: DataFrame, entries: DataFrame, calendar: DataFrame, design: DataFrame, rates: DataFrame, rules: TrialRules
) -> DataFrame:
    """Configured against target rates of every sku and region on the days they traded.

    ``entries`` lists a rate only on days it was set: the latest one up to a day holds.
    """
    latest = asof_lookup(active, entries, ["sku_id", "region_id"], "dt", ["configured_rate", "participate_type"])
    target = rates.select("stage", "trial_group", "region_type", F.col("rate").alias("target_rate"))
    rows = (
        latest.join(calendar.select(F.col("day").alias("dt"), "stage"), "dt")
        .join(design.where("in_trial = 1").select("region_id", "city_unit", "region_type", "trial_group"), "region_id")
        .join(target, ["stage", "trial_group", "region_type"], "left")
    )
    configured = F.col("configured_rate").cast("double")
    rows = rows.withColumn("deviation", F.round(configured - F.col("target_rate"), 6))
    near_self = F.abs(configured - F.lit(rules.self_rate)) <= rules.self_rate_margin
    kinds = [
        (F.abs("deviation") > rules.max_deviation, "RATE_DEVIATION"),
        (F.col("participate_type") == rules.outside, "OUTSIDE_TRIAL"),
        ((F.col("region_type") == rules.agent_type) & near_self, "AGENT_AT_SELF_RATE"),
        (F.col("as_of").isNull(), "NOT_CONFIGURED"),
    ]
    alerts = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in kinds]))
    return rows.select(
        "dt", "sku_id", "region_id", "city_unit", "region_type", "trial_group", "stage", "as_of",
        configured.alias("configured_rate"), "target_rate", "deviation", "participate_type",
        F.array_join(alerts, ",").alias("alerts"),
        F.when(F.size(alerts) > 0, "RED").otherwise("OK").alias("status"),
    )


def price_swings(cards: DataFrame, skus: Sequence[object], rules: TrialRules) -> DataFrame:
    """Supply prices outside the trial per listed day: implied rate, and the swing since the listed day before."""
    rows = cards.where(F.col("sku_id").isin(list(skus))).groupBy("dt", "sku_id").agg(
        F.max("platform_price").alias("platform_price"),
        F.min("supply_price").alias("supply_price"),
        F.max("is_up_today").alias("is_new_listing"),
    )
    before = F.lag("supply_price").over(Window.partitionBy("sku_id").orderBy("dt"))
    platform, supply = F.col("platform_price").cast("double"), F.col("supply_price").cast("double")
    swing = F.round(raw_ratio(supply, before.cast("double")) - 1, 6)
    return rows.withColumn("swing", swing).select(
        "dt", "sku_id", platform.alias("platform_price"), supply.alias("supply_price"),
        F.round(raw_ratio(platform - supply, platform), 6).alias("implied_rate"), "swing", "is_new_listing",
        F.when(F.abs("swing") > rules.max_swing, "YELLOW").otherwise("OK").alias("status"),
    )


def _correlation(x: str, y: str) -> Column:
    """Pearson correlation; null where either side does not vary."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def power_inputs(
    facts: DataFrame, design: DataFrame, skus: Sequence[object], history: Sequence[date], fallback: DateWindow,
    rules: TrialRules,
) -> DataFrame:
    """Dispersion and correlation of weekly GMV per sku, and the cities a group needs.

    ``history`` lists the first days of natural weeks. A sku with fewer than
    ``least_weeks`` of them above zero takes the complete weeks of ``fallback`` instead. A
    city without sales in a week counts as zero. A city whose mean is zero has no
    coefficient of variation; a correlation over fewer than two cities, or of a side that
    does not vary, is null, and a sku without either has no verdict.
    """
    blocks = fallback.n_days // WEEK
    weeks = [("history", i + 1, first) for i, first in enumerate(history)]
    weeks += [("fallback", i + 1, fallback.first + timedelta(days=WEEK * i)) for i in range(blocks)]
    last = {basis: max((n for b, n, _ in weeks if b == basis), default=0) for basis in ("history", "fallback")}
    of_week = lambda b, n, f: F.struct(F.lit(b).alias("basis"), F.lit(n).alias("week"), F.lit(f).alias("first"))
    listed = F.array(*[of_week(*w) for w in weeks])
    first_day = min(f for _, _, f in weeks)
    window = DateWindow.of_days(first_day, max(f for _, _, f in weeks) + timedelta(days=WEEK - 1))

    inside = F.filter(listed, lambda w: (F.col("dt") >= w["first"]) & (F.col("dt") < F.date_add(w["first"], WEEK)))
    rows = trial_rows(facts, design, skus, window).groupBy("dt", "sku_id", "city_unit").agg(F.sum("delivered_amt").alias("gmv"))
    weekly = rows.withColumn("w", F.explode(inside)).groupBy("w.basis", "w.week", "sku_id", "city_unit").agg(F.sum("gmv").alias("gmv"))

    cities = design.where("in_trial = 1").select("city_unit").distinct()
    grid = cities.withColumn("sku_id", F.explode(F.array(*[F.lit(s) for s in skus]))).withColumn("w", F.explode(listed))
    grid = grid.select("city_unit", "sku_id", "w.basis", "w.week").join(weekly, ["basis", "week", "sku_id", "city_unit"], "left")
    grid = grid.withColumn("gmv", F.coalesce(F.col("gmv").cast("double"), F.lit(0.0)))

    sold = grid.where("basis = 'history'").groupBy("sku_id", "week").agg(F.max("gmv").alias("gmv"))
    enough = sold.groupBy("sku_id").agg(F.sum(flag(F.col("gmv") > 0)).alias("history_weeks"))
    basis = F.when(F.col("history_weeks") >= rules.least_weeks, "history").otherwise("fallback")
    chosen = enough.withColumn("basis", basis)
    series = grid.join(chosen, ["sku_id", "basis"])
    at = lambda n: F.max(F.when(F.col("week") == n, F.col("gmv")))
    end = F.when(F.col("basis") == "history", last["history"]).otherwise(last["fallback"])
    city = series.groupBy("sku_id", "basis", "history_weeks", "city_unit").agg(
        F.count(F.lit(1)).alias("n_weeks"), F.avg("gmv").alias("mean"), F.stddev_samp("gmv").alias("deviation"),
        at(1).alias("w1"), at(2).alias("w2"), at(end - 1).alias("w3"), at(end).alias("w4"),
    )
    power = city.withColumn("cv", F.when(F.col("mean") > 0, F.col("deviation") / F.col("mean"))).groupBy(
        "sku_id", "basis", "history_weeks"
    ).agg(
        F.count(F.lit(1)).alias("n_cities"), F.max("n_weeks").alias("n_weeks"), F.avg("cv").alias("sigma_raw"),
        _correlation("w1", "w2").alias("rho_pre"), _correlation("w3", "w4").alias("rho_post"),
    )
    power = power.withColumns(
        {"sigma_adjusted": F.col("sigma_raw") * rules.cv_factor, "rho_main": F.least("rho_pre", "rho_post")}
    ).withColumn(
        "n_required",
        F.lit(4.0) * F.col("sigma_adjusted") * F.col("sigma_adjusted") * (F.lit(1.0) - F.col("rho_main"))
        * rules.z_square / rules.effect_square,
    )
    verdict = first_match(
        [(F.col("n_required").isNull(), "undefined"), (F.col("n_required") <= rules.cities_per_group, "sufficient")], "insufficient"
    )

    side = lambda n: grid.where("basis = 'history'").select("city_unit", "week", F.col("sku_id").alias(n), F.col("gmv").alias(f"gmv_{n}"))
    pairs = side("a").join(side("b"), ["city_unit", "week"]).where("a <> b").groupBy("a", "b").agg(_correlation("gmv_a", "gmv_b").alias("rho"))
    flagged = pairs.where(F.round("rho", 6) > rules.max_pair_correlation).groupBy(F.col("a").alias("sku_id")).agg(
        F.array_join(F.array_sort(F.collect_list(F.col("b").cast("string"))), ",").alias("correlated_skus")
    )
    rounded = ("sigma_raw", "sigma_adjusted", "rho_pre", "rho_post", "rho_main")
    return power.join(flagged, "sku_id", "left").select(
        "sku_id", "basis", "history_weeks", "n_cities", "n_weeks", *[F.round(c, 6).alias(c) for c in rounded],
        F.round("n_required", 4).alias("n_required"), F.lit(rules.cities_per_group).alias("n_actual"),
        verdict.alias("verdict"), F.coalesce("correlated_skus", F.lit("")).alias("correlated_skus"),
    )
