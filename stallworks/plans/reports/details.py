"""Item-level detail reports: order items (29 columns) and after-sale tickets (50 columns).

The large joins here are on the order or the item. Daily snapshots are reduced to one
row per key before they are joined, so nothing fans out; where a key is hot, AQE
splits its partition of the fact side. Columns that follow from others (``derived``) are
added after the last join, so that no join shuffles them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.text import canonical_name, quoted_list, strip_query
from ...functions.values import presence, relabel
from ...operators.joins import snapshot_join
from ...operators.metrics import collect_map, pick_preferred
from ...params import DateWindow
from ...sources.tables import scan_window
from ..rules import APPLY_TYPES, COMPLAINT_TYPES, Rules
from .stores import active_agent_grids

PLACE = ["province_id", "province_name", "city_id", "city_name", "county_id", "county_name"]
STORE_ATTRIBUTES = [*PLACE, "grid_id", "grid_name"]
GOODS_ATTRIBUTES = ["sku_name", "merchant_name", "back_category_id", "back_category"]
EXTRA_ATTRIBUTES = ["sku_grade", "producing_area", "packaging"]
#: Times of a ticket as the report spells them.
TIMES = {"arrival_time": "arrival_time", "apply_time": "create_time", "claim_time": "claim_time", "handle_time": "handle_time"}
#: Days before the window in which the order of a ticket may lie.
LOOKBACK = 30


def reformat(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _stores(store_dim: DataFrame, home_mall: int, window: DateWindow, lookback: int) -> DataFrame:
    rows = scan_window(store_dim, "dt", window, lookback)
    return pick_preferred(
        rows, ["dt", "store_id"], STORE_ATTRIBUTES, F.col("mall_id") == home_mall, null_is_other=False
    )


def _agents(agent_grid: DataFrame, window: DateWindow, lookback: int) -> DataFrame:
    return F.broadcast(active_agent_grids(agent_grid, window.padded(lookback)).withColumn("agent", F.lit(1)))


def order_item_detail(
    t: Mapping[str, DataFrame],
    rules: Rules,
    window: DateWindow,
    home_mall: int,
    merchant_names: Sequence[tuple[str, str]] = (),
    cancelled: str = "CANCEL",
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Order items with the store, goods and grid attributes of their own day.

    Goods and extra attributes come first: items that lie by sku stay there for both.
    """
    items = scan_window(t["item"], "dt", window).where(F.col("status") != cancelled)
    goods = scan_window(t["goods"], "dt", window, LOOKBACK)
    extra = scan_window(t["extra"], "dt", window, LOOKBACK)
    rows = snapshot_join(items, goods, ["sku_id"], GOODS_ATTRIBUTES)
    rows = snapshot_join(rows, extra, ["sku_id", "mall_id"], EXTRA_ATTRIBUTES)
    rows = snapshot_join(rows, _stores(t["store_dim"], home_mall, window, 0), ["store_id"], STORE_ATTRIBUTES)
    rows = rows.join(_agents(t["agent_grid"], window, LOOKBACK), ["dt", "mall_id", "grid_id"], "left")
    rows = rows.withColumns(dict(derived or {}))
    merchant = canonical_name("merchant_name", merchant_names) if merchant_names else F.col("merchant_name")
    as_double = lambda c: F.col(c).cast("double").alias(c)
    return rows.select(
        "dt", "order_item_id", "order_item_no", "order_id", "order_no", "sku_id", "sku_name", merchant.alias("merchant_name"),
        "back_category_id", "back_category", *EXTRA_ATTRIBUTES, "store_id", *STORE_ATTRIBUTES,
        "ordered_num", as_double("ordered_amt"), as_double("delivered_amt"), "delivered_num", as_double("payment_amt"), "mall_id",
        presence("agent", rules.agent_label, rules.direct_label).alias("operate_type"),
    )


def after_sale_detail(
    t: Mapping[str, DataFrame],
    rules: Rules,
    window: DateWindow,
    home_mall: int,
    image_host: str,
    cancelled: str = "CANCEL",
    merchant_names: Sequence[tuple[str, str]] = (),
    apply_types: dict[str, str] = APPLY_TYPES,
    complaint_types: dict[str, str] = COMPLAINT_TYPES,
    derived: Mapping[str, Column] | None = None,
    item_key: str = "order_item_id",
    within: Sequence[str] = (),
) -> DataFrame:
    """After-sale tickets opened in the window, with reasons, evidence and attributes.

    A ticket is about one order item; store, goods and grid are those of that item's day,
    which may lie up to 30 days before the window, and delivery photos those of its order.
    Only the items that tickets name are kept, before they are joined to anything.
    ``item_key`` is the ticket's column that holds the id of its item. ``within`` names columns
    of tickets, items, reasons, ticket items and tracks that these ids determine, such as the
    order: rows are joined on them as well, so what lies by order stays there.
    """
    within = list(within)
    tickets = scan_window(t["ticket"], "create_time", window).where(F.col("status") != cancelled)
    by_ticket = [*within, "ticket_id"]
    ids = tickets.select(*by_ticket).distinct()
    reasons = collect_map(
        t["reason"].where(F.col("deleted") == 0).join(ids, by_ticket, "left_semi"), by_ticket, "problem_type", "point_name"
    ).withColumnRenamed("items", "problems")
    items = scan_window(t["item"], "dt", window, LOOKBACK).select(*within, "order_item_id", "dt", F.col("order_no").alias("item_order_no"))
    named = tickets.select(*within, F.col(item_key).alias("order_item_id")).distinct()
    items = items.join(named, [*within, "order_item_id"], "left_semi").groupBy(*within, "order_item_id").agg(
        F.min(F.struct("dt", "item_order_no")).alias("__item")  # an item listed twice does not repeat its ticket
    ).select(*within, F.col("order_item_id").alias(item_key), "__item.*")
    tracks = t["track"].where(F.col("deliver_status") == "COMPLETE").select(
        *within, F.col("order_no").alias("item_order_no"), strip_query("track_file").alias("track_file")
    )
    items = items.join(tracks, [*within, "item_order_no"], "left").drop("item_order_no")
    goods = scan_window(t["goods"], "dt", window, LOOKBACK)
    extra = scan_window(t["extra"], "dt", window, LOOKBACK)
    rows = (
        tickets.join(t["ticket_item"], by_ticket, "left")
        .join(reasons, by_ticket, "left")
        .join(items, [*within, item_key], "left")
        .withColumns({c: F.col(c).cast("double") for c in ("expected_amt", "final_amt")})
    )
    rows = snapshot_join(rows, goods, ["sku_id"], GOODS_ATTRIBUTES)
    rows = snapshot_join(rows, extra, ["sku_id", "mall_id"], EXTRA_ATTRIBUTES)
    rows = snapshot_join(rows, _stores(t["store_dim"], home_mall, window, LOOKBACK), ["store_id"], STORE_ATTRIBUTES)
    rows = rows.join(_agents(t["agent_grid"], window, LOOKBACK), ["dt", "mall_id", "grid_id"], "left")
    rows = rows.withColumns(dict(derived or {}))
    merchant = canonical_name("merchant_name", merchant_names) if merchant_names else F.col("merchant_name")
    return rows.select(
        F.to_date("create_time").alias("apply_day"),
        "ticket_id", "ticket_no", "refund_no", relabel("apply_type", apply_types).alias("apply_type"),
        "order_id", "order_no", "order_item_id", "order_item_no", "sku_id", "sku_code", "sku_name", "defective_rate",
        "back_category_id", "back_category", *EXTRA_ATTRIBUTES, merchant.alias("merchant_name"), "store_id", *PLACE,
        quoted_list("track_file").alias("track_files"),
        "expected_amt", "bad_weight", "bad_num",
        "problems",
        quoted_list("images", image_host).alias("images"),
        quoted_list("videos", image_host).alias("videos"),
        "handler_id", "handler_name",
        relabel("complaint_type", complaint_types).alias("complaint_type"),
        "remark", "problem_remark", "handle_remark", "service_remark",
        "final_amt",
        "status", "real_status",
        *[reformat(c).alias(n) for n, c in TIMES.items()], "handle_duration", "mall_id",
        presence("agent", rules.agent_label, rules.direct_label).alias("operate_type"),
    )
