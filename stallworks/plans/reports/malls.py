"""Mall, category and complaint reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.dates import is_month_end, month_key
from ...functions.values import any_positive, nz, ratio, raw_ratio
from ...operators.metrics import Metrics, aggregate
from ...operators.ranking import previous_value, rank_desc, text_changed
from ...params import DateWindow
from ...sources.tables import scan_window
from ..rules import Rules
from .common import (
    category_flags,
    flow_stat,
    other_complaints,
    penetration_counts,
    ranked_cat4,
    target_skus,
    upgrade_stat,
)

KEYS = ["dt", "mall_id", "cat1", "cat4"]


def _double(c: str) -> Column:
    return nz(F.col(c).cast("double"), 0.0).alias(c)


def _count(c: str) -> Column:
    return nz(F.col(c).cast("bigint")).alias(c)


def _enriched(t: Mapping[str, DataFrame], rules: Rules, window: DateWindow, keep: Column | None) -> DataFrame:
    ranked = ranked_cat4(t["mall_cat4"], t["mall_cat1"], t["mall_day"], t["malls"], window, keep)
    skus = target_skus(t["sku_mall"], t["mall_cat1"], rules, window)
    other = other_complaints(t["complaint"], rules, window)
    return (
        ranked.join(skus, KEYS, "left")
        .join(other, KEYS, "left")
        .withColumns(category_flags(rules))
    )


def _times(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def category_kpis(
    t: Mapping[str, DataFrame], rules: Rules, window: DateWindow, keep: Column | None = None
) -> DataFrame:
    """Level-1 category KPIs per day and mall.

    ``keep`` selects malls after ranking. Sums and all conditional distinct counts
    come out of one two-level aggregate.
    """
    upgrades = upgrade_stat(t["ticket"], t["orders"], t["goods"], window)
    rows = _enriched(t, rules, window, keep).join(upgrades, KEYS, "left")
    sums = {
        "delivered_amt": F.col("delivered_amt"),
        "delivered_amt_filtered": _times("is_filtered", "delivered_amt"),
        "refund_amt": F.col("refund_amt"),
        "delivered_num": F.col("delivered_num"),
        "after_sale_num": F.col("after_sale_num"),
        "refund_amt_filtered": _times("is_filtered", "refund_amt"),
        "sku_onsale": F.col("sku_num_onsale"),
        "sku_sold": F.col("sku_num_sold"),
        "delivered_amt_pilot": _times("is_pilot", "delivered_amt"),
        "refund_amt_pilot": _times("is_pilot", "refund_amt"),
        "delivered_amt_special": _times("is_special", "delivered_amt"),
        "target_sku_special": _times("target_sku_num", "is_special"),
        "order_cnt_special": _times("is_special", "order_cnt"),
        "after_sale_num_special": _times("after_sale_num", "is_special"),
        "other_refund_special": _times("other_refund_amt", "is_special"),
        "other_after_sale_num_special": _times("other_after_sale_num", "is_special"),
        "other_after_sale_cnt_special": _times("other_after_sale_cnt", "is_special"),
        "upgrade_refund": F.col("upgrade_refund"),
        "upgrade_platform_refund": F.col("upgrade_platform_refund"),
        "upgrade_tickets": F.col("upgrade_tickets"),
    }
    counts = penetration_counts(rules)
    stat = aggregate(rows, ["dt", "mall_id", "mall", "cat1"], Metrics(sums=sums, distincts=counts))
    flow = flow_stat(t["flow"], ["dt", "mall_id", "cat1"], rules, window)
    cat1 = scan_window(t["mall_cat1"], "dt", window).withColumnRenamed("ordered_store_num", "ordered_stores")
    day = scan_window(t["mall_day"], "dt", window).select(
        "dt", "mall_id", F.col("ordered_store_num").alias("mall_stores")
    )
    joined = (
        stat.join(cat1, ["dt", "mall_id", "cat1"], "left")
        .join(day, ["dt", "mall_id"], "left")
        .join(flow, ["dt", "mall_id", "cat1"], "left")
    )
    amounts = [c for c in sums if "amt" in c or "refund" in c]
    return joined.select(
        "dt", "mall_id", "mall", "cat1",
        _count("ordered_stores"),
        ratio("ordered_stores", "mall_stores").alias("dau_rate"),
        *[_double(c) if c in amounts else _count(c) for c in sums],
        *[_count(c) for c in counts],
        _count("exposed_stores"), _count("exposed_stores_page"), _count("exposed_views_page"),
    )


def mall_kpis(
    t: Mapping[str, DataFrame], rules: Rules, window: DateWindow, keep: Column | None = None
) -> DataFrame:
    """Mall KPIs per day with rounded, null-safe ratios."""
    rows = _enriched(t, rules, window, keep)
    sums = {
        "delivered_amt": F.col("delivered_amt"),
        "refund_amt": F.col("refund_amt"),
        "delivered_amt_filtered": _times("is_filtered", "delivered_amt"),
        "refund_amt_filtered": _times("is_filtered", "refund_amt"),
        "sku_onsale": F.col("sku_num_onsale"),
        "sku_sold": F.col("sku_num_sold"),
        "sku_sold_fruit": _times("sku_num_sold", "is_fruit"),
        "delivered_amt_pilot": _times("is_pilot", "delivered_amt"),
        "refund_amt_pilot": _times("is_pilot", "refund_amt"),
        "sku_onsale_vegetable": _times("is_vegetable", "sku_num_onsale"),
        "delivered_amt_vegetable": _times("is_vegetable", "delivered_amt"),
        "refund_amt_vegetable": _times("is_vegetable", "refund_amt"),
        "delivered_amt_fruit": _times("is_fruit", "delivered_amt"),
        "delivered_amt_special": _times("is_special", "delivered_amt"),
        "order_cnt_special": _times("is_special", "order_cnt"),
        "target_sku_special": _times("target_sku_num", "is_special"),
        "after_sale_num_special": _times("after_sale_num", "is_special"),
        "other_refund_special": _times("other_refund_amt", "is_special"),
        "other_after_sale_num_special": _times("other_after_sale_num", "is_special"),
        "other_after_sale_cnt_special": _times("other_after_sale_cnt", "is_special"),
    }
    counts = penetration_counts(rules)
    stat = aggregate(rows, ["dt", "mall_id", "mall"], Metrics(sums=sums, distincts=counts))
    flow = flow_stat(t["flow"], ["dt", "mall_id"], rules, window)
    day = scan_window(t["mall_day"], "dt", window)
    joined = stat.join(day, ["dt", "mall_id"], "left").join(flow, ["dt", "mall_id"], "left")
    amounts = [c for c in sums if "amt" in c or "refund" in c]
    ratios = {
        "refund_rate": ("refund_amt", "delivered_amt"),
        "refund_rate_filtered": ("refund_amt_filtered", "delivered_amt_filtered"),
        "page_usage": ("exposed_stores_page", "exposed_stores"),
        "refund_rate_vegetable": ("refund_amt_vegetable", "delivered_amt_vegetable"),
        "fruit_share": ("delivered_amt_fruit", "delivered_amt"),
        "refund_rate_special": ("other_refund_special", "delivered_amt_special"),
        "other_ticket_share": ("other_after_sale_cnt_special", "after_sale_num_special"),
    }
    return joined.select(
        "dt", "mall_id", "mall",
        "ordered_store_num", "ordered_store_num_old", "ordered_store_num_new", "ordered_store_num_loss",
        *[_double(c) if c in amounts else _count(c) for c in sums],
        *[_count(c) for c in counts],
        _count("exposed_stores"), _count("exposed_stores_page"), _count("exposed_views_page"),
        *[ratio(a, b).alias(n) for n, (a, b) in ratios.items()],
    )


def card_updates(goods: DataFrame, window: DateWindow) -> DataFrame:
    """Per day, mall and category: skus put on the shelf, and those whose text changed.

    Reads one day more on the left so that the first day has a predecessor. The first
    row of a sku counts as changed when it has a text.
    """
    active = scan_window(goods, "dt", window, lookback=1).where(any_positive("is_up_today", "is_sku_valid"))
    cards = active.select(
        "dt", "mall_id", "cat4", "sku_id", "is_up_today", "merit",
        previous_value(["sku_id", "mall_id"], "dt", "merit").alias("merit_before"),
    )
    up = F.col("is_up_today") > 0
    counted = aggregate(
        cards,
        ["dt", "mall_id", "cat4"],
        Metrics(
            distincts={
                "updated_sku_num": ("sku_id", text_changed("merit", "merit_before") & up),
                "onshelf_sku_num": ("sku_id", up),
            }
        ),
    )
    return scan_window(counted, "dt", window)


def category4_stat(
    t: Mapping[str, DataFrame], rules: Rules, window: DateWindow, keep: Column | None = None
) -> DataFrame:
    """Level-4 category detail with ranks and shelf changes."""
    ranked = ranked_cat4(t["mall_cat4"], t["mall_cat1"], t["mall_day"], t["malls"], window, keep)
    skus = target_skus(t["sku_mall"], t["mall_cat1"], rules, window)
    updates = card_updates(t["goods_card"], window)
    return (
        ranked.join(skus, KEYS, "left")
        .join(updates, ["dt", "mall_id", "cat4"], "left")
        .select(
            "dt",
            month_key("dt").alias("dt_month"),
            is_month_end("dt").alias("is_last_day"),
            "mall", "cat1", "cat2", "cat3", "cat4_id", "cat4",
            F.col("delivered_amt").cast("double").alias("delivered_amt"),
            F.col("refund_amt").cast("double").alias("refund_amt"),
            "sku_num_onsale", "sku_num_sold", "exposed_store_num_old", "ordered_store_num_old",
            "penetration", "order_cnt", "target_sku_num",
            F.col("delivered_amt_rank").cast("bigint").alias("delivered_amt_rank"),
            F.col("penetration_rank").cast("bigint").alias("penetration_rank"),
            "onshelf_sku_num", "updated_sku_num",
        )
    )


def complaint_ratio_rank(complaints: DataFrame, mall_cat4: DataFrame, window: DateWindow) -> DataFrame:
    """Refund share of every complaint type in its category, with its rank.

    The share may stay null; for the rank null counts as 0.
    """
    facts = scan_window(complaints, "dt", window)
    base = scan_window(mall_cat4, "dt", window).select(*KEYS, "delivered_amt")
    share = raw_ratio("refund_amt", "delivered_amt")
    joined = facts.join(base, KEYS, "left").withColumn("share", share)
    rank = rank_desc(KEYS, "share", ["type_desc"])
    return joined.withColumn("ratio_rank", rank.cast("bigint")).select(
        *KEYS, "type_desc", F.round("share", 4).alias("refund_ratio"), "ratio_rank"
    )


def merchant_category(facts: DataFrame, rules: Rules, window: DateWindow) -> DataFrame:
    """Merchants' fruit categories that had orders."""
    rows = scan_window(facts, "dt", window)
    return rows.where((F.col("cat1") == rules.fruit_cat1) & (F.col("ordered_num") > 0)).select(
        "dt", "merchant_id", "cat1", "cat4", "ordered_store_num",
        F.col("delivered_amt").cast("double").alias("delivered_amt"),
        F.col("refund_amt").cast("double").alias("refund_amt"),
    )


def paid_by(items: DataFrame, by: list[str], cancelled: str, window: DateWindow) -> DataFrame:
    """Payments of items that were not cancelled. Aggregated before any join."""
    rows = scan_window(items, "dt", window).where(F.col("status") != cancelled)
    return rows.groupBy(*by).agg(F.sum("payment_amt").alias("payment_amt"))


def sku_payments(
    skus: DataFrame, items: DataFrame, rules: Rules, window: DateWindow, cancelled: str = "CANCEL"
) -> DataFrame:
    """Fruit skus with what was paid for them; null when nothing was."""
    rows = scan_window(skus, "dt", window).where(
        (F.col("cat1") == rules.fruit_cat1) & (F.col("ordered_num") > 0)
    )
    paid = paid_by(items, ["dt", "sku_id"], cancelled, window)
    return rows.join(paid, ["dt", "sku_id"], "left").select(
        "dt", "merchant_id", "cat1", "cat4", "sku_id", "ordered_store_num",
        *[F.col(c).cast("double").alias(c) for c in ("delivered_amt", "payment_amt", "refund_amt", "refund_quality")],
    )


def store_category_payments(
    facts: DataFrame, items: DataFrame, goods: DataFrame, window: DateWindow, cancelled: str = "CANCEL"
) -> DataFrame:
    """Store × level-1 category with payments; the item's category is that day's."""
    snapshot = scan_window(goods, "dt", window).select("dt", "sku_id", "cat1").distinct()
    days = scan_window(items, "dt", window).where(F.col("status") != cancelled)
    # Per sku first: the join then meets one row per store, sku and day. What was paid is dealt by
    # store, like the facts.
    per_sku = days.groupBy("dt", "store_id", "sku_id").agg(F.sum("payment_amt").alias("payment_amt"))
    paid = (
        per_sku.join(snapshot, ["dt", "sku_id"], "left")
        .repartition("store_id")
        .groupBy("dt", "store_id", "cat1")
        .agg(F.sum("payment_amt").alias("payment_amt"))
    )
    rows = scan_window(facts, "dt", window).where(nz("ordered_num") > 0)
    money = ("ordered_amt", "delivered_amt", "payment_amt", "refund_amt", "refund_quality", "commission_amt", "natural_refund_amt")
    return rows.join(paid, ["dt", "store_id", "cat1"], "left").select(
        "dt", "store_id", "cat1_id", "cat1", "ordered_num", "delivered_num",
        *[F.col(c).cast("double").alias(c) for c in money],
    )

