"""Building blocks several reports share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.values import any_positive, flag, is_one_of, nz, ratio, raw_ratio
from ...operators.metrics import Metrics, aggregate
from ...operators.ranking import rank_then_keep
from ...params import DateWindow
from ...sources.tables import scan_window
from ..rules import Rules


def upgrade_stat(
    tickets: DataFrame, orders: DataFrame, goods: DataFrame, window: DateWindow, by_store: bool = False,
    near: Sequence[str] = (),
) -> DataFrame:
    """Upgrade tickets on the day of the order they belong to.

    ``tickets`` is the latest snapshot, ``orders`` gives the day, ``goods`` the
    categories on that day (left: a ticket may have none). ``near`` names the columns by which
    the facts lie that the result is joined to; it is dealt by them before it is added up.
    """
    by = ["dt", "mall_id", "cat1", "cat4", *(["store_id"] if by_store else [])]
    days = scan_window(orders.select("order_id", "dt"), "dt", window)
    snapshot = scan_window(goods.select("dt", "mall_id", "sku_id", "cat1", "cat4"), "dt", window)
    dated = tickets.join(days, "order_id").join(snapshot, ["dt", "mall_id", "sku_id"], "left")
    if near:
        dated = dated.select(*by, "ticket_no", "confirmed_amt", "credit_amt").repartition(*near)
    return aggregate(
        dated,
        by,
        Metrics(
            sums={
                "upgrade_refund": nz("confirmed_amt") + nz("credit_amt"),
                "upgrade_platform_refund": nz("credit_amt"),
            },
            distincts={"upgrade_tickets": ("ticket_no", None)},
        ),
    )


def flow_stat(flow: DataFrame, by: Sequence[str], rules: Rules, window: DateWindow) -> DataFrame:
    """Stores exposed, stores exposed on one page, exposures on that page."""
    active = scan_window(flow, "dt", window).where(
        any_positive("exposed_num", "clicked_num", "added_num", "ordered_num")
    )
    exposed = F.col("exposed_num") > 0
    on_page = exposed & (F.col("page") == rules.flow_page)
    return aggregate(
        active,
        by,
        Metrics(
            sums={"exposed_views_page": Metrics.when_sum(on_page, F.col("exposed_num"))},
            distincts={
                "exposed_stores": ("store_id", exposed),
                "exposed_stores_page": ("store_id", on_page),
            },
        ),
    )


def target_skus(sku_mall: DataFrame, mall_cat1: DataFrame, rules: Rules, window: DateWindow) -> DataFrame:
    """Skus that reach a share of their category's stores; groups without any are left out."""
    skus = scan_window(sku_mall, "dt", window)
    whole = scan_window(mall_cat1, "dt", window).select(
        "dt", "mall_id", "cat1", F.col("ordered_store_num").alias("cat1_stores")
    )
    reached = raw_ratio("ordered_store_num", "cat1_stores") >= rules.sku_target_share
    counted = aggregate(
        skus.join(whole, ["dt", "mall_id", "cat1"], "left"),
        ["dt", "mall_id", "cat1", "cat4"],
        Metrics(distincts={"target_sku_num": ("sku_id", reached)}),
    )
    return counted.where(F.col("target_sku_num") > 0)


def other_complaints(complaints: DataFrame, rules: Rules, window: DateWindow) -> DataFrame:
    """Complaints that are not about quality. A complaint without a type is neither."""
    rows = scan_window(complaints, "dt", window).where(~is_one_of("type_desc", rules.quality_types))
    return rows.groupBy("dt", "mall_id", "cat1", "cat4").agg(
        F.sum("refund_amt").alias("other_refund_amt"),
        F.sum("after_sale_num").alias("other_after_sale_num"),
        F.sum("after_sale_cnt").alias("other_after_sale_cnt"),
    )


def ranked_cat4(
    mall_cat4: DataFrame,
    mall_cat1: DataFrame,
    mall_day: DataFrame,
    malls: DataFrame,
    window: DateWindow,
    keep: Column | None,
) -> DataFrame:
    """Category rows with penetration, and their rank among all malls of a category-day.

    The ranks compare malls, so the mall filter comes after them; only what every mall
    needs is joined before, the rest is joined to the kept rows.
    """
    facts = scan_window(mall_cat4, "dt", window).where(F.col("cat4").isNotNull())
    cat1 = scan_window(mall_cat1, "dt", window).select(
        "dt", "mall_id", "cat1", F.col("ordered_store_num").alias("cat1_stores")
    )
    day = scan_window(mall_day, "dt", window).select(
        "dt", "mall_id", F.col("ordered_store_num").alias("mall_stores")
    )
    wide = (
        facts.join(malls.select("mall_id"), "mall_id")
        .join(cat1, ["dt", "mall_id", "cat1"], "left")
        .join(day, ["dt", "mall_id"], "left")
        .withColumns(
            {
                "__penetration": raw_ratio("ordered_store_num", "cat1_stores"),
                "__dau": raw_ratio("ordered_store_num", "mall_stores"),
            }
        )
    )
    ranked = rank_then_keep(
        wide,
        ["cat1", "cat4", "dt"],
        {
            "delivered_amt_rank": "delivered_amt",
            "penetration_rank": "__penetration",
            "dau_rank": "__dau",
        },
        ["mall_id"],
        keep,
    )
    return ranked.withColumns(
        {
            "penetration": ratio("ordered_store_num", "cat1_stores"),
            "dau_rate": ratio("ordered_store_num", "mall_stores"),
        }
    ).drop("__penetration", "__dau")


def category_flags(rules: Rules) -> dict[str, Column]:
    """0/1 marks of the category lists."""
    special = is_one_of("cat4", rules.special_cat4)
    return {
        "is_filtered": F.when(special, 0).otherwise(1),
        "is_pilot": flag(is_one_of("cat4", rules.pilot_cat4)),
        "is_special": flag(special),
        "is_vegetable": flag(is_one_of("cat1", rules.vegetable_cat1)),
        "is_fruit": flag(F.col("cat1") == rules.fruit_cat1),
    }


def penetration_counts(rules: Rules) -> dict[str, tuple[str, Column]]:
    """Distinct level-4 categories per penetration bucket."""
    p, sold = F.col("penetration"), F.col("sku_num_sold") > 0
    out: dict[str, Column] = {
        "cat4_onsale": F.col("sku_num_onsale") > 0,
        "cat4_sold": sold,
    }
    for name, low, high in rules.penetration_bins:
        out[name] = p >= low if high is None else (p >= low) & (p < high)
    out["cat4_penetration_lt05"] = (p < rules.low_penetration) & sold
    out["cat4_penetration_ge15"] = p >= rules.high_penetration
    out["cat4_penetration_top"] = (p >= rules.high_penetration) & (
        F.col("penetration_rank") <= rules.top_rank
    )
    out["cat4_penetration_special"] = (p >= rules.special_penetration) & (F.col("is_special") == 1)
    return {name: ("cat4", cond) for name, cond in out.items()}
