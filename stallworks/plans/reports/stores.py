"""Store-level reports: sales reps, detail feed, rolling statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.text import has, matches_any
from ...functions.values import any_positive, first_match, flag, is_one_of, nz, presence
from ...operators.metrics import Metrics, aggregate, pick_preferred
from ...operators.ranking import one_per_key_any
from ...operators.rolling import Band, rolling_by_spine
from ...params import DateWindow
from ...sources.tables import scan_window
from ..rules import Rules
from .common import upgrade_stat

PLACE = ["province_id", "province_name", "city_id", "city_name", "county_id", "county_name"]
UPGRADE_KEYS = ["dt", "mall_id", "cat1", "cat4", "store_id"]

#: Last 7, 14 and 30 days including the output day, and the 7 days before the last 7.
LAST_7, LAST_14, LAST_30, BEFORE_7 = Band("d7", 0, 6), Band("d14", 0, 13), Band("d30", 0, 29), Band("p7", 7, 13)


def active_store_facts(facts: DataFrame, window: DateWindow) -> DataFrame:
    """Stores that saw, clicked, added, ordered, complained or bought again; a delivery alone is no activity."""
    rows = scan_window(facts, "dt", window)
    return rows.where(any_positive("exposed_num", "clicked_num", "added_num", "ordered_num", "after_sale_num", "rebuy_num"))


def active_agent_grids(agent_grid: DataFrame, window: DateWindow) -> DataFrame:
    """Agent-run grids per day, one row each however often they are listed.

    At most a row for each day of the window and grid, however many facts there are: small
    enough to be sent to the facts, which are not shuffled for it.
    """
    rows = scan_window(agent_grid, "dt", window).where(F.col("status") == 1)
    return F.broadcast(one_per_key_any(rows, ["dt", "mall_id", "grid_id"]))


def sales_rep_kpis(
    t: Mapping[str, DataFrame], rules: Rules, window: DateWindow, home_mall: int
) -> DataFrame:
    """Sales-rep KPIs per day, mall and kind of grid.

    Grid and rep come from the fact, else from the day's store snapshot (the home
    mall's entry first), grid names at last from the grid snapshot.
    """
    facts = scan_window(t["store_cat4"], "dt", window).where(F.col("ordered_num") > 0)
    fallback = {c: f"store_{c}" for c in ("grid_id", "grid_name", "bd_id", "bd_name")}
    snapshot = pick_preferred(
        scan_window(t["store_dim"], "dt", window),
        ["dt", "store_id"],
        list(fallback),
        F.col("mall_id") == home_mall,
    ).withColumnsRenamed(fallback)
    agents = active_agent_grids(t["agent_grid"], window).select(
        "dt", "mall_id", F.col("grid_id").alias("grid_key"), F.lit(1).alias("agent")
    )
    # like the agent-run grids at most a row for each day and grid; the facts lie by store and day
    grids = F.broadcast(scan_window(t["grid_day"], "dt", window).select(
        "dt", F.col("grid_id").alias("grid_key"), F.col("grid_name").alias("day_grid_name")
    ))
    upgrades = upgrade_stat(t["ticket"], t["orders"], t["goods"], window, by_store=True, near=["dt", "store_id"])
    joined = (
        facts.join(snapshot, ["dt", "store_id"], "left")
        .withColumn("grid_key", F.coalesce("grid_id", "store_grid_id"))
        .join(agents, ["dt", "mall_id", "grid_key"], "left")
        .join(upgrades, UPGRADE_KEYS, "left")
        .join(grids, ["dt", "grid_key"], "left")
    )
    any_grid = F.coalesce("grid_name", "store_grid_name", "day_grid_name", F.lit(""))
    online = has(any_grid, rules.online_tag)
    bd_id, bd_name = F.coalesce("bd_id", "store_bd_id"), F.coalesce("bd_name", "store_bd_name")
    named = bd_name.isNotNull()
    rep_id = first_match(
        [
            (bd_id.isNotNull(), bd_id),
            (~named & online, F.lit(rules.online_rep[0]).cast("bigint")),
        ],
        F.lit(rules.missing_rep[0]).cast("bigint"),
    )
    rep_name = first_match([(named, bd_name), (online, rules.online_rep[1])], rules.missing_rep[1])
    rows = joined.select(
        "dt", "mall_id", "mall", "store_id", "delivered_amt", "delivered_wgt",
        presence("agent", rules.agent_label, rules.direct_label).alias("operate_type"),
        rep_id.alias("rep_id"),
        rep_name.alias("rep_name"),
        flag(~is_one_of("cat4", rules.special_cat4)).alias("keep"),
        nz("upgrade_refund").alias("upgrade_refund"),
    )
    stat = aggregate(
        rows,
        ["dt", "mall_id", "mall", "operate_type", "rep_id", "rep_name"],
        Metrics(
            sums={
                "delivered_amt": nz("delivered_amt"),
                "delivered_wgt": nz("delivered_wgt"),
                "delivered_amt_ex_special": nz("delivered_amt") * F.col("keep"),
                "upgrade_refund_ex_special": F.col("upgrade_refund") * F.col("keep"),
            },
            distincts={"ordered_stores": ("store_id", None)},
        ),
    )
    amounts = ("delivered_amt", "delivered_wgt", "delivered_amt_ex_special", "upgrade_refund_ex_special")
    return stat.withColumns({c: F.col(c).cast("double") for c in amounts})


def trial_group(county: str, grid_name: str, rules: Rules) -> Column:
    """Treatment or control inside the trial counties, else null."""
    inside = matches_any(county, rules.trial_counties)
    tagged = has(grid_name, rules.trial_grid_tag)
    return first_match(
        [(inside & tagged, rules.treatment_label), (inside & ~tagged, rules.control_label)]
    )


def store_category_detail(
    t: Mapping[str, DataFrame], rules: Rules, window: DateWindow
) -> DataFrame:
    """Store × level-4 category feed with trial, pilot, after-sale and rebuy marks: 32 columns."""
    facts = active_store_facts(t["store_feed"], window)
    # several counties may serve a store on a day: one of them, with its own city and province
    place = F.max(F.struct("county_name", *[c for c in PLACE if c != "county_name"])).alias("place")
    snapshot = scan_window(t["store_dim"], "dt", window).groupBy("dt", "store_id", "mall_id").agg(place)
    snapshot = snapshot.select("dt", "store_id", "mall_id", "place.*")
    agents = active_agent_grids(t["agent_grid"], window).withColumn("agent", F.lit(1))
    upgrades = upgrade_stat(t["ticket"], t["orders"], t["goods"], window, by_store=True, near=["store_id"])
    joined = (
        facts.join(snapshot, ["dt", "store_id", "mall_id"], "left")
        .join(agents, ["dt", "mall_id", "grid_id"], "left")
        .join(upgrades, UPGRADE_KEYS, "left")
    )
    group = trial_group("county_name", "grid_name", rules)
    special = is_one_of("cat4", rules.special_cat4)
    as_double = lambda c: F.col(c).cast("double").alias(c)
    return joined.select(
        "dt", "mall_id", "mall", "grid_id", "grid_name",
        presence("agent", rules.agent_label, rules.direct_label).alias("operate_type"),
        "bd_id", "bd_name", "store_id", *PLACE, "cat1_id", "cat1", "cat4_id", "cat4",
        flag(is_one_of("cat1", rules.vegetable_cat1) & (F.col("ordered_num") > 0)).alias("is_vegetable"),
        flag(group == rules.treatment_label).alias("is_trial"),
        group.alias("trial_group"),
        flag(is_one_of("cat4", rules.pilot_cat4)).alias("is_pilot"),
        F.when(special, rules.special_label).alias("special_label"),
        as_double("delivered_amt"), as_double("refund_amt"), "ordered_num", as_double("commission_amt"),
        flag(F.col("after_sale_num") > 0).alias("is_after_sale"),
        flag(nz("rebuy_days") + nz("ordered_num") > 0).alias("is_rebuy"),
        nz(F.col("upgrade_refund").cast("double"), 0.0).alias("upgrade_refund"),
        nz(F.col("upgrade_platform_refund").cast("double"), 0.0).alias("upgrade_platform_refund"),
    )


def rolling_report(
    daily: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    sum_bands: Sequence[Band],
    day_bands: Sequence[Band],
    active: dict[str, Column],
    window: DateWindow,
    horizon: int,
    direction: str = "backward",
) -> DataFrame:
    """Measures of the day, their band sums and the active days per band.

    The scan is widened by the horizon on the side the sums look at.
    """
    back = direction == "backward"
    rows = scan_window(daily, "dt", window, horizon if back else 0, 0 if back else horizon)
    bands = list(dict.fromkeys([*sum_bands, *day_bands]))
    rolled = rolling_by_spine(
        rows, keys, "dt", window, measures, bands, active, horizon, direction
    )
    wanted = [f"{m}_{b.name}" for b in sum_bands for m in measures]
    wanted += [f"{a}_{b.name}" for b in day_bands for a in active]
    return rolled.select(*keys, "dt", *measures, *wanted)


def store_rolling(daily: DataFrame, window: DateWindow, direction: str = "backward") -> DataFrame:
    """Ten store measures: same day, last 30, 14 and 7 days; exposed and ordered days: 48 columns.

    Refunds count on the day of their order and, as ``natural_refund_amt``, on their own day.
    """
    measures = [
        "exposed_cnt", "ordered_amt", "delivered_amt", "delivered_num", "after_sale_num_quality",
        "after_sale_num", "refund_quality", "refund_amt", "natural_refund_amt", "commission_amt",
    ]
    active = {"exposed_days": F.col("exposed_cnt") > 0, "ordered_days": F.col("ordered_num") > 0}
    rows = daily.where(any_positive("exposed_cnt", "ordered_amt", "natural_refund_amt"))
    return rolling_report(
        rows, ["store_id"], measures, [LAST_30, LAST_14, LAST_7], [LAST_30, BEFORE_7, LAST_7],
        active, window, horizon=29, direction=direction,
    )


def category_rolling(daily: DataFrame, window: DateWindow, direction: str = "backward") -> DataFrame:
    """Ten category measures: same day, the week before the last and the last 7 days."""
    measures = [
        "merchant_num_onsale", "sku_num_sold", "ordered_amt", "ordered_num", "ordered_store_num",
        "delivered_amt", "delivered_num", "after_sale_store_num", "refund_amt", "refund_quality",
    ]
    active = {"ordered_days": F.col("ordered_num") > 0}
    return rolling_report(
        daily, ["cat1", "cat4"], measures, [BEFORE_7, LAST_7], [BEFORE_7, LAST_7],
        active, window, horizon=14, direction=direction,
    )
