"""The supplied tables in the roles the reports expect.

``Roles`` builds each role as a DataFrame; ``ROLE_SQL`` states the same role in SQL
for the check. Money is decimal, so sums are exact and do not depend on order.

Stand-ins: store = customer, sku = part, merchant = supplier, mall = region,
grid = nation, level-1 category = part type, level-4 category = brand, sales rep =
market segment. Returned lines are complaints; open lines count as ordered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.values import flag
from ..operators.metrics import Metrics, aggregate
from ..operators.reshape import on_two_days, whole_rows
from ..params import DateWindow
from ..sources.tables import scan_window

#: The reports' windows over orders and over events.
ORDER_DAYS = DateWindow.of_days(date(1995, 1, 1), date(2001, 8, 1))
EVENT_DAYS = DateWindow.of_days(date(2024, 1, 1), date(2024, 1, 31))
#: Events moved onto order days, so that reports can join the two.
EVENT_SHIFT_DAYS = 8400

#: All event days, in SQL; ``Roles.event_days`` is the same window.
EVENT_FIRST = "(SELECT MIN(CAST(ts AS DATE)) FROM events)"
EVENT_LAST = "(SELECT MAX(CAST(ts AS DATE)) FROM events)"

HOME_MALL = 2  # the mall single-mall reports are about
FRUIT = "ECONOMY"
VEGETABLES = ["LARGE", "SMALL"]
SPECIAL_CAT4 = ["Brand#1", "Brand#7", "Brand#12"]
PILOT_CAT4 = ["Brand#3", "Brand#9"]
QUALITY_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
CANCELLED = "P"
#: Ids of categories that the tables only name.
CAT1_IDS = {"STANDARD": 1, "SMALL": 2, "MEDIUM": 3, "LARGE": 4, "ECONOMY": 5, "PROMO": 6}
REP_IDS = {"MACHINERY": 1, "AUTOMOBILE": 2, "FURNITURE": 3, "HOUSEHOLD": 4}


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")


def rate(c: str) -> Column:
    return F.col(c).cast("decimal(4,2)")


def cat1_id(c: str) -> Column:
    pairs = [F.lit(x) for kv in CAT1_IDS.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.col(c)).cast("bigint")


def cat4_id(c: str) -> Column:
    return F.substring_index(c, "#", -1).cast("bigint")


#: Columns of an order item by name: the line's column, and how it is read.
LINE_COLUMNS: dict[str, tuple[str, Callable[[str], Column]]] = {
    "line_no": ("l_linenumber", F.col),
    "sku_id": ("l_partkey", F.col),
    "merchant_id": ("l_suppkey", F.col),
    "qty": ("l_quantity", money),
    "amt": ("l_extendedprice", money),
    "disc": ("l_discount", rate),
    "tax": ("l_tax", rate),
    "returnflag": ("l_returnflag", F.col),
    "linestatus": ("l_linestatus", F.col),
    "shipped": ("l_shipdate", F.to_date),
}
ITEM_COLUMNS = (
    "sku_id", "mall_id", "grid_id", "store_id", "order_id", "line_no", "merchant_id", "qty", "amt", "disc", "tax",
    "returnflag", "linestatus", "status", "priority", "dt", "rep", "grid_name", "mall", "cat1", "cat4",
)


class Roles:
    """Role tables over one data folder. All lazy; nothing is read here."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A supplied table. Opened once: finding its schema is a job of its own."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    def days_of(self, table: str, column: str) -> DateWindow:
        """All days a table has, for plans that no window is asked of."""
        row = self.table(table).agg(F.min(column), F.max(column)).first()
        first, last = (v.date() if isinstance(v, datetime) else v for v in row)
        return DateWindow.of_days(first or ORDER_DAYS.first, last or ORDER_DAYS.first)

    @cached_property
    def order_days(self) -> DateWindow:
        return self.days_of("orders", "o_orderdate")

    @cached_property
    def ship_days(self) -> DateWindow:
        return self.days_of("lineitem", "l_shipdate")

    @cached_property
    def event_days(self) -> DateWindow:
        return self.days_of("events", "ts")

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines as supplied."""
        return self.table("lineitem")

    @cached_property
    def order_rows(self) -> DataFrame:
        """Orders, of known stores and others."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("store_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.to_date("o_orderdate").alias("dt"),
            F.col("o_orderdate").alias("ordered_at"),
        )

    @cached_property
    def placed_orders(self) -> DataFrame:
        """Orders with rep, grid and mall of their store."""
        return self.at_store(self.order_rows)

    @cached_property
    def item_lines(self) -> DataFrame:
        return self.lines.select(
            F.col("l_orderkey").alias("order_id"),
            *[read(c).alias(n) for n, (c, read) in LINE_COLUMNS.items() if c in self.lines.columns],
        )

    @cached_property
    def item_goods(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_type").alias("cat1"),
            F.col("p_brand").alias("cat4"),
        )

    @cached_property
    def item(self) -> DataFrame:
        """Order items with order, store, mall, grid and category."""
        # orders are placed before lines meet them, so lines are dealt by goods and by order only
        rows = self.item_lines.join(self.item_goods, "sku_id").join(self.placed_orders, "order_id")
        return rows.select(*[c for c in ITEM_COLUMNS if c in rows.columns])

    @cached_property
    def item_by_sku(self) -> DataFrame:
        """The same items, joined so that they end up lying by sku."""
        rows = self.item_lines.join(self.placed_orders, "order_id").join(self.item_goods, "sku_id")
        return rows.select(*[c for c in ITEM_COLUMNS if c in rows.columns])

    @cached_property
    def item_by_store(self) -> DataFrame:
        """The same items for sums of a store's day."""
        return self.item

    @cached_property
    def item_by_order(self) -> DataFrame:
        """The same items for counts of orders."""
        return self.item

    @cached_property
    def ordered_lines(self) -> DataFrame:
        """Lines with order and goods, of known stores and others; they lie by sku."""
        return self.item_lines.join(self.order_rows, "order_id").join(self.item_goods, "sku_id")

    def named(self, df: DataFrame) -> DataFrame:
        """Add the names of grid and mall to rows with both ids."""
        return df.join(self.nation, ["grid_id", "mall_id"]).join(self.mall, "mall_id")

    def in_one_pass(
        self, lines: Sequence[str], orders: Sequence[str], places: Sequence[str] = ("mall_id",), items: Sequence[str] = (),
        window: DateWindow | None = None,
    ) -> "Roles":
        """The same roles over lines and orders that are dealt by order once, for all of them.

        For reports that join several roles to lines. ``lines`` and ``orders`` name the columns
        that its roles read, ``places`` those of a store's place. With ``items``, the columns read
        of lines with their order and goods, these are dealt by sku once for all roles as well.
        ``window`` holds the order days that all of them read. An order carries the places of
        its store as a list, so that orders of unknown stores, and stores listed twice, count in
        each role as they do in the plain ones; names are looked up where ``places`` has the
        grid. Lines and orders without an order id are left out: nothing joins them.
        """
        held = Roles(self.spark, self.dir)
        held._tables = self._tables
        stores = held.store  # names, and what is listed twice, come with ``named`` where the grid is known
        if "grid_id" in places:
            stores = held.customer.join(held.nation.select("grid_id", "mall_id").distinct(), "grid_id").join(held.mall_ids, "mall_id")
        rows = held._with_places(orders, stores, places, window)
        by_order = self.lines.select("l_orderkey", *lines).where("l_orderkey IS NOT NULL").repartition("l_orderkey")
        held.__dict__["lines"] = whole_rows(by_order, "l_orderkey")
        if items:
            met = held.item_lines.join(rows, "order_id").join(held.item_goods, "sku_id")
            met = whole_rows(met.select("sku_id", *items, "places"), "sku_id")
            held.__dict__["ordered_lines"] = met.drop("places")
            held.__dict__["item"] = held.__dict__["item_by_sku"] = held._placed(met)
            if "grid_id" in places:
                held.__dict__["item_by_store"] = held._placed(met.repartition("dt", "store_id"))
        return held

    def laid_by_category(self, orders: Sequence[str], items: Sequence[str], kept: Sequence[str], window: DateWindow) -> "Roles":
        """The same roles over lines that meet goods and orders once, items of which are then dealt by ``ITEM_PLACE``.

        For reports that join measures of categories to the store feed. Columns ``items`` are
        read of lines with their order and goods, ``kept`` of items where they lie by category.
        """
        held = Roles(self.spark, self.dir)
        held._tables = self._tables
        stores = held.customer.join(held.nation, "grid_id").join(held.mall_ids, "mall_id")
        rows = held._with_places(orders, stores, ["mall_id"], window)
        met = held.item_lines.join(held.item_goods, "sku_id").join(rows, "order_id")
        met = whole_rows(met.select("order_id", *items, "places"), "order_id")
        held.__dict__["ordered_lines"] = met.drop("places")
        placed = held._placed(met)
        dealt = placed.select(*ITEM_PLACE, *kept).repartition(*ITEM_PLACE)
        held.__dict__["item_by_order"] = placed.join(held.mall, "mall_id")
        held.__dict__["placed_orders"] = held.placed_orders.join(held.mall, "mall_id")
        held.__dict__["item"] = whole_rows(dealt, *ITEM_PLACE).join(held.mall, "mall_id")
        # as a unit, or a report's check for categories without a name would split the shared exchange
        held.__dict__["mall_cat1"] = whole_rows(held.mall_cat1, "dt", "mall_id")
        return held

    @cached_property
    def mall_ids(self) -> DataFrame:
        return self.mall.select("mall_id").distinct()

    def _with_places(self, orders: Sequence[str], stores: DataFrame, places: Sequence[str], window: DateWindow | None) -> DataFrame:
        """Orders by order, each with the places of its store; the roles of orders are derived from them."""
        of_store = stores.groupBy("store_id").agg(F.collect_list(F.struct(*places)).alias("places"))
        rows = self.order_rows if window is None else scan_window(self.order_rows, "dt", window)
        rows = rows.select("order_id", *orders).where("order_id IS NOT NULL").join(of_store, "store_id", "left")
        rows = whole_rows(rows.repartition("order_id"), "order_id")
        self.__dict__["order_rows"] = rows.drop("places")
        self.__dict__["placed_orders"] = self._placed(rows)
        return rows

    def _placed(self, df: DataFrame) -> DataFrame:
        """Rows with a list of places, once for each; with names where the grid is known."""
        rows = df.select(*[c for c in df.columns if c != "places"], F.inline("places"))
        return self.named(rows) if "grid_id" in rows.columns else rows

    def stored(self, window: DateWindow = ORDER_DAYS) -> "Roles":
        """The same roles over an ``item`` of the window, joined once for all reports of a session.

        For reports that roll several roles up from it: the four-table join runs with the
        first of them, every role after that scans the columns it needs. Nothing is written
        while a plan is built; see ``shared_items``.
        """
        held = Roles(self.spark, self.dir)
        held._tables = self._tables
        held.__dict__["item"] = held.__dict__["item_by_sku"] = shared_items(self, window.padded(lookback=1))
        return held

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("store_id"),
            F.col("c_nationkey").cast("bigint").alias("grid_id"),
            F.col("c_mktsegment").alias("rep"),
        )

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("grid_id"),
            F.col("n_name").alias("grid_name"),
            F.col("n_regionkey").cast("bigint").alias("mall_id"),
        )

    def at_grid(self, df: DataFrame) -> DataFrame:
        """Add grid and mall to rows with a grid_id.

        The dimensions join one after the other: a join of two dimensions is estimated as
        their product, which would look too large to broadcast.
        """
        return df.join(self.nation, "grid_id").join(self.mall, "mall_id")

    def at_store(self, df: DataFrame) -> DataFrame:
        """Add rep, grid and mall to rows with a store_id."""
        return self.at_grid(df.join(self.customer, "store_id"))

    @cached_property
    def store(self) -> DataFrame:
        return self.at_grid(self.customer)

    @cached_property
    def grid(self) -> DataFrame:
        return self.nation.join(self.mall, "mall_id")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.table("supplier").select(
            "s_suppkey",
            F.col("s_nationkey").cast("bigint").alias("grid_id"),
            flag(F.col("s_acctbal") < 0).alias("status"),
        )

    @cached_property
    def mall(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("mall_id"), F.col("r_name").alias("mall")
        )

    @cached_property
    def store_cat4(self) -> DataFrame:
        return self.store_cat4_with()

    def store_cat4_with(self, *names: str) -> DataFrame:
        """Store × level-4 category per day, with the named measures or all of them. Some stores lack a grid or a rep here."""
        measures = {
            "delivered_amt": lambda: F.sum("amt"),
            "delivered_wgt": lambda: F.sum("qty"),
            "delivered_num": lambda: F.count(F.lit(1)),
            "ordered_num": lambda: F.sum(flag(F.col("linestatus") == "O")),
            "refund_amt": lambda: F.sum(refund()),
            "commission_amt": lambda: F.sum(F.col("amt") * F.col("tax")),
            "after_sale_num": lambda: F.sum(flag(F.col("returnflag") == "R")),
            "rebuy_days": lambda: F.sum(flag(F.col("returnflag") == "A")),
        }
        daily = self.item_by_store.groupBy(
            "dt", "mall_id", "mall", "store_id", "grid_id", "grid_name", "rep", "cat1", "cat4"
        ).agg(*[measure().alias(n) for n, measure in measures.items() if not names or n in names])
        on_house = F.col("rep") == "HOUSEHOLD"
        bd = F.when(F.col("rep") != "BUILDING", F.col("rep"))
        pairs = [F.lit(x) for kv in REP_IDS.items() for x in kv]
        return daily.withColumns(
            {
                "bd_name": bd,
                "bd_id": F.try_element_at(F.create_map(*pairs), bd).cast("bigint"),
                "grid_id": F.when(~on_house, F.col("grid_id")),
                "grid_name": F.when(~on_house, F.col("grid_name")),
            }
        ).drop("rep")

    @cached_property
    def store_feed(self) -> DataFrame:
        """Store × level-4 category per day: what a store saw, ordered, sent back and bought again.

        Items and page flow are tagged with their measures, put in one union and added up at
        once, so stores that only saw, clicked or added have a row as well.
        """
        zero = {m: F.lit(0) for m in ("exposed_num", "clicked_num", "added_num", "ordered_num", "after_sale_num", "rebuy_days", "rebuy_num")}
        zero |= {m: F.lit(0).cast("decimal(16,4)") for m in ("delivered_amt", "refund_amt", "commission_amt")}
        tagged = lambda df, own: df.select(
            "dt", "store_id", "cat1", "cat4", *[own.get(m, z).cast("decimal(16,4)" if m.endswith("amt") else "bigint").alias(m) for m, z in zero.items()]
        )
        again = F.col("returnflag") == "A"
        bought = tagged(self.ordered_lines, {
            "ordered_num": flag(F.col("linestatus") == "O"), "after_sale_num": flag(F.col("returnflag") == "R"),
            "rebuy_days": flag(again), "rebuy_num": flag(again & (F.col("linestatus") == "O")),
            "delivered_amt": F.col("amt"), "refund_amt": refund(), "commission_amt": F.col("amt") * F.col("tax"),
        })
        flow = self.page_flow.select("dt", "store_id", "sku_id", "exposed_num", "clicked_num", "added_num").join(self.item_goods, "sku_id")
        seen = tagged(flow, {m: F.col(m) for m in ("exposed_num", "clicked_num", "added_num")})
        # rows of known stores: they are dealt by store once, for the sums and for what is joined by store
        known = self.customer.select("store_id").distinct().hint("shuffle_hash")
        rows = bought.unionByName(seen).join(known, "store_id")
        daily = rows.groupBy("dt", "store_id", "cat1", "cat4").agg(
            *[F.sum(m).alias(m) for m in zero]
        )
        on_house = F.col("rep") == "HOUSEHOLD"
        bd = F.when(F.col("rep") != "BUILDING", F.col("rep"))
        pairs = [F.lit(x) for kv in REP_IDS.items() for x in kv]
        return self.at_store(daily).withColumns(
            {
                "bd_name": bd,
                "bd_id": F.try_element_at(F.create_map(*pairs), bd).cast("bigint"),
                "grid_id": F.when(~on_house, F.col("grid_id")),
                "grid_name": F.when(~on_house, F.col("grid_name")),
                "cat1_id": cat1_id("cat1"),
                "cat4_id": cat4_id("cat4"),
            }
        ).drop("rep")

    @cached_property
    def mall_cat4(self) -> DataFrame:
        return self.mall_cat4_with()

    def mall_cat4_with(self, *names: str) -> DataFrame:
        """Mall × level-4 category per day, with the named measures or all of them.

        Every kind of entity that is counted costs a copy of the rows, so a report names
        what it reads.
        """
        ordered = F.col("linestatus") == "O"
        sums = {
            "delivered_amt": F.col("amt"),
            "refund_amt": refund(),
            "refund_quality": refund_quality(),
            "ordered_amt": F.when(ordered, F.col("amt")).otherwise(0),
            "delivered_num": F.lit(1),
            "ordered_num": flag(ordered),
            "after_sale_num": flag(F.col("returnflag") == "R"),
            "order_cnt": F.lit(1),
        }
        distincts = {
            "ordered_store_num": ("store_id", ordered),
            "ordered_store_num_old": ("store_id", ordered & (F.col("status") == "F")),
            "exposed_store_num_old": ("store_id", F.col("status") == "F"),
            "after_sale_store_num": ("store_id", F.col("returnflag") == "R"),
            "sku_num_onsale": ("sku_id", None),
            "sku_num_sold": ("sku_id", ordered),
            "merchant_num_onsale": ("merchant_id", None),
        }
        wanted = lambda d: {n: e for n, e in d.items() if not names or n in names}
        by = ["dt", "mall_id", "mall", "cat1", "cat4"]
        return aggregate(self.item, by, Metrics(sums=wanted(sums), distincts=wanted(distincts)))

    @cached_property
    def mall_cat1(self) -> DataFrame:
        ordered = F.col("linestatus") == "O"
        return aggregate(
            self.item,
            ["dt", "mall_id", "cat1"],
            Metrics(distincts={"ordered_store_num": ("store_id", ordered)}),
        )

    @cached_property
    def mall_day(self) -> DataFrame:
        ordered = F.col("linestatus") == "O"
        status = lambda s: ("store_id", ordered & (F.col("status") == s))
        return aggregate(
            self.item,
            ["dt", "mall_id"],
            Metrics(
                distincts={
                    "ordered_store_num": ("store_id", ordered),
                    "ordered_store_num_old": status("F"),
                    "ordered_store_num_new": status("O"),
                    "ordered_store_num_loss": status("P"),
                }
            ),
        )

    def _sku(self, by: list[str], *names: str) -> DataFrame:
        ordered = F.col("linestatus") == "O"
        sums = {
            "ordered_num": flag(ordered),
            "delivered_amt": F.col("amt"),
            "refund_amt": refund(),
            "refund_quality": refund_quality(),
        }
        wanted = {n: e for n, e in sums.items() if not names or n in names}
        return aggregate(self.item, by, Metrics(sums=wanted, distincts={"ordered_store_num": ("store_id", ordered)}))

    @cached_property
    def sku_mall(self) -> DataFrame:
        return self.sku_mall_with()

    def sku_mall_with(self, *names: str) -> DataFrame:
        """Mall × sku per day: the stores that ordered, with the named sums or all of them."""
        return self._sku(["dt", "mall_id", "cat1", "cat4", "sku_id"], *names)

    @cached_property
    def sku_day(self) -> DataFrame:
        return self._sku(["dt", "mall_id", "merchant_id", "cat1", "cat4", "sku_id"])

    @cached_property
    def merchant_cat4(self) -> DataFrame:
        return self._sku(["dt", "mall_id", "merchant_id", "cat1", "cat4"])

    @cached_property
    def complaint(self) -> DataFrame:
        """Complaints by type: lines that came back, type = order priority."""
        returned = self.item_by_order.where(F.col("returnflag") != "N")
        return aggregate(
            returned,
            ["dt", "mall_id", "cat1", "cat4", "priority"],
            Metrics(
                sums={"refund_amt": F.col("amt") * F.col("disc"), "after_sale_num": F.lit(1)},
                distincts={"after_sale_cnt": ("order_id", None)},
            ),
        ).withColumnRenamed("priority", "type_desc")

    @cached_property
    def orders(self) -> DataFrame:
        return self.order_rows.select("order_id", "dt")

    @cached_property
    def ticket(self) -> DataFrame:
        """Upgrade tickets: returned and finished lines. They carry no order day."""
        lines = self.lines.where(
            (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        )
        # orders are placed first, so tickets lie by order, where reports look up its day
        return lines.join(self.placed_orders, F.col("l_orderkey") == F.col("order_id")).select(
            "store_id",
            "mall_id",
            F.col("l_orderkey").alias("order_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ticket_no"),
            F.col("l_partkey").alias("sku_id"),
            (money("l_extendedprice") * rate("l_discount")).alias("confirmed_amt"),
            (money("l_extendedprice") * rate("l_tax")).alias("credit_amt"),
        )

    @cached_property
    def goods_day(self) -> DataFrame:
        """Goods snapshot: what a mall sold on a day, with its categories. It lies by sku, where it is looked up."""
        return self.item_by_sku.select("dt", "mall_id", "sku_id", "cat1", "cat4").distinct()

    @cached_property
    def goods_card(self) -> DataFrame:
        """Goods cards by shipping day and mall of the supplier; texts change over time."""
        lines = self.table("lineitem").select(
            F.to_date("l_shipdate").alias("dt"), "l_partkey", "l_suppkey", "l_returnflag",
            "l_linestatus", "l_quantity", "l_extendedprice", "l_tax",
        )
        supplier = self.supplier
        part = self.table("part").select(
            F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"),
            F.col("p_type").alias("cat1"), F.col("p_brand").alias("cat4"),
        )
        # lines of known goods: they are dealt by goods once, for the cards and for their texts
        lines = lines.withColumnRenamed("l_partkey", "sku_id")
        sold = self.at_grid(lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))
        daily = (
            sold.join(part.select("sku_id").hint("shuffle_hash"), "sku_id", "left_semi")
            .groupBy("dt", "mall_id", "sku_id")
            .agg(
                F.max(F.concat("l_returnflag", "l_linestatus")).alias("merit_raw"),
                F.max(flag(F.col("l_linestatus") == "O")).alias("is_up_today"),
                F.max(flag(F.col("l_quantity") >= 10)).alias("is_sku_valid"),
                F.max(money("l_extendedprice")).alias("standard_price"),
                F.max(rate("l_tax")).alias("commission_rate"),
                F.max("l_suppkey").alias("merchant_id"),
            )
        )
        return daily.join(part, "sku_id").withColumn(
            "merit", F.when(F.col("merit_raw") != "NO", F.col("merit_raw"))
        ).drop("merit_raw")

    @cached_property
    def page_flow(self) -> DataFrame:
        """Page flow per event, moved onto order days."""
        return self.table("events").select(
            F.date_sub(F.to_date("ts"), EVENT_SHIFT_DAYS).alias("dt"),
            F.col("user_id").alias("store_id"),
            F.col("event_type").alias("page"),
            F.floor("value").cast("bigint").alias("exposed_num"),
            flag(F.col("event_type") == "click").alias("clicked_num"),
            flag(F.col("event_type") == "signup").alias("added_num"),
            flag(F.col("event_type") == "purchase").alias("ordered_num"),
            F.get_json_object("props", "$.k").cast("bigint").alias("sku_id"),
        )

    @cached_property
    def flow(self) -> DataFrame:
        """Page flow with the store's mall and the category of the event's part."""
        part = self.table("part").select(
            F.col("p_partkey").alias("sku_id"), F.col("p_type").alias("cat1")
        )
        located = self.at_store(self.page_flow).drop("rep", "grid_id", "grid_name", "mall")
        return located.join(part, "sku_id")

    @cached_property
    def store_dim(self) -> DataFrame:
        """Store snapshot: per day one row for every mall and grid that served the store."""
        orders = self.order_rows.select("order_id", "store_id", "dt")
        served = self.served("grid_id").join(orders, F.col("l_orderkey") == F.col("order_id"))
        # The grids of a store's day are collected once: what reads them by store meets them in one place.
        grids = served.groupBy("dt", "store_id").agg(F.collect_set("grid_id").alias("grids"))
        places = self.nation.distinct().join(self.mall.distinct(), "mall_id")
        return (
            grids.select("dt", "store_id", F.explode("grids").alias("grid_id"))
            .join(F.broadcast(places), "grid_id")
            .select(
                "dt", "store_id", "mall_id", "grid_id", "grid_name",
                F.col("mall_id").alias("province_id"), F.col("mall").alias("province_name"),
                F.floor(F.col("grid_id") / 3).cast("bigint").alias("city_id"),
                F.concat(F.lit("CITY "), F.floor(F.col("grid_id") / 3).cast("string")).alias("city_name"),
                (F.col("grid_id") + 500).alias("county_id"), F.concat(F.lit("COUNTY "), "grid_name").alias("county_name"),
                F.when(F.col("mall") != "ASIA", F.col("grid_id") + 100).alias("bd_id"),
                F.when(F.col("mall") != "ASIA", F.concat(F.lit("REP "), "grid_name")).alias("bd_name"),
            )
        )

    def served(self, *columns: str) -> DataFrame:
        """Order of each line with columns of its supplier, who is looked up before anything is shuffled."""
        lines = self.lines.select("l_orderkey", "l_suppkey")
        return lines.join(self.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", *columns)

    @cached_property
    def agent_grid(self) -> DataFrame:
        """Agent-run grids: several rows per grid and day, status 1 while active."""
        ordered = self.served("grid_id", "status", "s_suppkey").join(self.orders, F.col("l_orderkey") == F.col("order_id"))
        return self.at_grid(ordered).select(
            "dt", "mall_id", "grid_id", "grid_name", "status", F.col("s_suppkey").alias("agent_id")
        )

    @cached_property
    def grid_day(self) -> DataFrame:
        return self.item.select("dt", "grid_id", "grid_name").distinct()

    @cached_property
    def store_cat1(self) -> DataFrame:
        """Store × level-1 category per day: refunds on the order's day and, once more, on the day they were paid."""
        # dealt by store before a line is copied to its second day, for the sums and the store's place
        items = self.ordered_lines.withColumnRenamed("dt", "ordered").repartition("store_id")
        paid = F.when(F.col("returnflag") == "R", F.col("shipped"))
        rows = on_two_days(items, F.col("ordered"), paid, mark="second")
        own, open_line = ~F.col("second"), F.col("linestatus") == "O"
        on_own = lambda value: F.sum(F.when(own, value).otherwise(0))
        daily = rows.groupBy("dt", "store_id", "cat1").agg(
            on_own(flag(open_line)).alias("ordered_num"),
            on_own(F.when(open_line, F.col("amt")).otherwise(0)).alias("ordered_amt"),
            on_own(F.lit(1)).alias("delivered_num"),
            on_own(F.col("amt")).alias("delivered_amt"),
            on_own(refund()).alias("refund_amt"),
            on_own(refund_quality()).alias("refund_quality"),
            on_own(F.col("amt") * F.col("tax")).alias("commission_amt"),
            F.sum(F.when(F.col("second"), refund()).otherwise(0)).alias("natural_refund_amt"),
        )
        return self.at_store(daily).drop("rep", "grid_id", "grid_name", "mall").withColumn("cat1_id", cat1_id("cat1"))

    @cached_property
    def visit_two_days(self) -> DataFrame:
        """Store measures per event day; complaints on the day of their order, their refund on its own day too."""
        kind = F.col("event_type")
        events = self.table("events").select(
            F.col("user_id").alias("store_id"), "event_type", money("value").alias("amount"), F.to_date("ts").alias("happened"),
            (F.col("event_id") % 3).cast("int").alias("late"),
        )
        ordered = F.when(kind == "error", F.date_sub("happened", F.col("late")))
        rows = on_two_days(events, F.col("happened"), ordered, mark="on_order_day")
        late, big = F.col("on_order_day"), F.col("amount") > 20
        part = lambda cond, v: F.sum(F.when(cond, v).otherwise(0))
        return rows.groupBy("dt", "store_id").agg(
            part(kind == "view", F.lit(1)).alias("exposed_cnt"),
            part(kind == "purchase", F.col("amount")).alias("ordered_amt"),
            part(kind == "purchase", F.lit(1)).alias("ordered_num"),
            part(kind == "click", F.col("amount")).alias("delivered_amt"),
            part(kind == "click", F.lit(1)).alias("delivered_num"),
            part(late, F.lit(1)).alias("after_sale_num"),
            part(late & big, F.lit(1)).alias("after_sale_num_quality"),
            part(late, F.col("amount")).alias("refund_amt"),
            part(late & big, F.col("amount")).alias("refund_quality"),
            part((kind == "error") & ~late, F.col("amount")).alias("natural_refund_amt"),
            part(kind == "signup", F.col("amount")).alias("commission_amt"),
        )

    @cached_property
    def visit(self) -> DataFrame:
        """Store measures per event day."""
        kind = F.col("event_type")
        value = money("value")
        part = lambda k, v: F.sum(F.when(kind == k, v).otherwise(0))
        return (
            self.table("events")
            .groupBy(F.to_date("ts").alias("dt"), F.col("user_id").alias("store_id"))
            .agg(
                part("view", F.lit(1)).alias("exposed_cnt"),
                part("purchase", value).alias("ordered_amt"),
                part("purchase", F.lit(1)).alias("ordered_num"),
                part("click", value).alias("delivered_amt"),
                part("click", F.lit(1)).alias("delivered_num"),
                part("error", F.lit(1)).alias("after_sale_num"),
                F.sum(F.when((kind == "error") & (F.col("value") > 20), 1).otherwise(0)).alias("after_sale_num_quality"),
                part("error", value).alias("refund_amt"),
                F.sum(F.when((kind == "error") & (F.col("value") > 20), value).otherwise(0)).alias("refund_quality"),
                part("signup", value).alias("commission_amt"),
            )
        )

    @cached_property
    def reject(self) -> DataFrame:
        """Quality rejects: error events, entity = user."""
        return self.table("events").where(F.col("event_type") == "error").select(
            F.to_date("ts").alias("dt"), F.col("user_id").alias("goods_id"), "event_id"
        )


#: What nearly every role over items groups by; kept items lie together by it.
ITEM_PLACE = ("dt", "mall_id", "cat1")

#: The joined items that reports of this session share, by application, folder and days.
_SHARED: dict[tuple[str, str, date, date], DataFrame] = {}


def shared_items(roles: Roles, window: DateWindow) -> DataFrame:
    """``item`` of some days, kept by the executors once a report has asked for it.

    Items are dealt by day, mall and category once. Roles that group by these and more
    (stores, skus, orders, level-4 categories) are then added up, and joined, where the
    items lie; none of them moves the items again.

    Blocks of a lost executor are joined anew from the tables. One folder and window is held
    at a time: asking for others, or ``release_items``, frees it.
    """
    key = (roles.spark.sparkContext.applicationId, roles.dir, window.first, window.last)
    if key not in _SHARED:
        release_items()
        rows = scan_window(roles.item, "dt", window).repartition(*ITEM_PLACE)
        _SHARED[key] = rows.persist(StorageLevel.MEMORY_AND_DISK)
    return _SHARED[key]


def release_items() -> None:
    """Free the items that reports share."""
    while _SHARED:
        (application, *_), items = _SHARED.popitem()
        context = items.sparkSession.sparkContext
        if context._jsc is not None and context.applicationId == application:
            items.unpersist()


def refund() -> Column:
    return F.when(F.col("returnflag") == "R", F.col("amt") * F.col("disc")).otherwise(0)


def refund_quality() -> Column:
    quality = (F.col("returnflag") == "R") & F.col("priority").isin(QUALITY_TYPES)
    return F.when(quality, F.col("amt") * F.col("disc")).otherwise(0)


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_MONEY = "CAST({0} AS DECIMAL(12,2))"
_RATE = "CAST({0} AS DECIMAL(4,2))"
_REFUND = "SUM(CASE WHEN returnflag = 'R' THEN amt * disc ELSE 0 END)"
_REFUND_Q = f"SUM(CASE WHEN returnflag = 'R' AND priority IN ({_list(QUALITY_TYPES)}) THEN amt * disc ELSE 0 END)"
_ORDERED = "linestatus = 'O'"


def _n(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


def _d(entity: str, cond: str) -> str:
    return f"COUNT(DISTINCT {entity}) FILTER (WHERE {cond})"


_SKU = (
    f"{_n(_ORDERED)} AS ordered_num, SUM(amt) AS delivered_amt, {_REFUND} AS refund_amt, "
    f"{_REFUND_Q} AS refund_quality, {_d('store_id', _ORDERED)} AS ordered_store_num FROM item"
)

ROLE_SQL: dict[str, str] = {
    "grid": """SELECT CAST(n_nationkey AS BIGINT) AS grid_id, n_name AS grid_name,
        CAST(n_regionkey AS BIGINT) AS mall_id, r_name AS mall
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "mall": "SELECT CAST(r_regionkey AS BIGINT) AS mall_id, r_name AS mall FROM region",
    "store": """SELECT c_custkey AS store_id, c_mktsegment AS rep, grid_id, grid_name, mall_id, mall
        FROM customer JOIN grid ON grid_id = c_nationkey""",
    "item": f"""SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS sku_id,
        l_suppkey AS merchant_id, {_MONEY.format('l_quantity')} AS qty,
        {_MONEY.format('l_extendedprice')} AS amt, {_RATE.format('l_discount')} AS disc,
        {_RATE.format('l_tax')} AS tax, l_returnflag AS returnflag, l_linestatus AS linestatus,
        s.store_id, o_orderstatus AS status, o_orderpriority AS priority,
        CAST(o_orderdate AS DATE) AS dt, s.grid_id, s.grid_name, s.mall_id, s.mall, s.rep,
        p_type AS cat1, p_brand AS cat4
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN store s ON s.store_id = o_custkey JOIN part ON p_partkey = l_partkey""",
    "store_cat4": f"""SELECT dt, mall_id, mall, store_id, cat1, cat4,
        CASE WHEN rep <> 'HOUSEHOLD' THEN grid_id END AS grid_id,
        CASE WHEN rep <> 'HOUSEHOLD' THEN grid_name END AS grid_name,
        CASE WHEN rep <> 'BUILDING' THEN rep END AS bd_name,
        CAST(CASE rep {' '.join(f"WHEN '{k}' THEN {v}" for k, v in REP_IDS.items())} END AS BIGINT) AS bd_id,
        SUM(amt) AS delivered_amt, SUM(qty) AS delivered_wgt, COUNT(*) AS delivered_num,
        {_n(_ORDERED)} AS ordered_num, {_REFUND} AS refund_amt, SUM(amt * tax) AS commission_amt,
        {_n("returnflag = 'R'")} AS after_sale_num, {_n("returnflag = 'A'")} AS rebuy_days
        FROM item GROUP BY dt, mall_id, mall, store_id, item.grid_id, item.grid_name, rep, cat1, cat4""",
    "store_feed": f"""SELECT dt, store.mall_id, store.mall, f.store_id, cat1, cat4,
        CAST(CASE cat1 {' '.join(f"WHEN '{k}' THEN {v}" for k, v in CAT1_IDS.items())} END AS BIGINT) AS cat1_id,
        CAST(split_part(cat4, '#', 2) AS BIGINT) AS cat4_id,
        CASE WHEN rep <> 'HOUSEHOLD' THEN grid_id END AS grid_id, CASE WHEN rep <> 'HOUSEHOLD' THEN grid_name END AS grid_name,
        CASE WHEN rep <> 'BUILDING' THEN rep END AS bd_name,
        CAST(CASE rep {' '.join(f"WHEN '{k}' THEN {v}" for k, v in REP_IDS.items())} END AS BIGINT) AS bd_id,
        exposed_num, clicked_num, added_num, COALESCE(ordered_num, 0) AS ordered_num, COALESCE(after_sale_num, 0) AS after_sale_num,
        COALESCE(rebuy_days, 0) AS rebuy_days, COALESCE(rebuy_num, 0) AS rebuy_num, COALESCE(delivered_amt, 0) AS delivered_amt,
        COALESCE(refund_amt, 0) AS refund_amt, COALESCE(commission_amt, 0) AS commission_amt FROM (
          SELECT dt, store_id, cat1, cat4, COALESCE(e.exposed_num, 0) AS exposed_num, COALESCE(e.clicked_num, 0) AS clicked_num,
          COALESCE(e.added_num, 0) AS added_num, i.* EXCLUDE (dt, store_id, cat1, cat4) FROM (
            SELECT dt, store_id, cat1, cat4, {_n(_ORDERED)} AS ordered_num, {_n("returnflag = 'R'")} AS after_sale_num,
            {_n("returnflag = 'A'")} AS rebuy_days, {_n("returnflag = 'A' AND linestatus = 'O'")} AS rebuy_num,
            SUM(amt) AS delivered_amt, {_REFUND} AS refund_amt, SUM(amt * tax) AS commission_amt
            FROM item GROUP BY dt, store_id, cat1, cat4) i
          FULL JOIN (SELECT CAST(ts AS DATE) - {EVENT_SHIFT_DAYS} AS dt, user_id AS store_id, p_type AS cat1, p_brand AS cat4,
            CAST(SUM(FLOOR(value)) AS BIGINT) AS exposed_num, {_n("event_type = 'click'")} AS clicked_num, {_n("event_type = 'signup'")} AS added_num
            FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT) GROUP BY 1, 2, 3, 4) e
          USING (dt, store_id, cat1, cat4)) f JOIN store ON store.store_id = f.store_id""",
    "mall_cat4": f"""SELECT dt, mall_id, mall, cat1, cat4, SUM(amt) AS delivered_amt,
        {_REFUND} AS refund_amt, {_REFUND_Q} AS refund_quality,
        SUM(CASE WHEN {_ORDERED} THEN amt ELSE 0 END) AS ordered_amt, COUNT(*) AS delivered_num,
        {_n(_ORDERED)} AS ordered_num, {_n("returnflag = 'R'")} AS after_sale_num, COUNT(*) AS order_cnt,
        {_d('store_id', _ORDERED)} AS ordered_store_num,
        {_d('store_id', _ORDERED + " AND status = 'F'")} AS ordered_store_num_old,
        {_d('store_id', "status = 'F'")} AS exposed_store_num_old,
        {_d('store_id', "returnflag = 'R'")} AS after_sale_store_num,
        COUNT(DISTINCT sku_id) AS sku_num_onsale, {_d('sku_id', _ORDERED)} AS sku_num_sold,
        COUNT(DISTINCT merchant_id) AS merchant_num_onsale
        FROM item GROUP BY dt, mall_id, mall, cat1, cat4""",
    "mall_cat1": f"""SELECT dt, mall_id, cat1, {_d('store_id', _ORDERED)} AS ordered_store_num
        FROM item GROUP BY dt, mall_id, cat1""",
    "mall_day": f"""SELECT dt, mall_id, {_d('store_id', _ORDERED)} AS ordered_store_num,
        {_d('store_id', _ORDERED + " AND status = 'F'")} AS ordered_store_num_old,
        {_d('store_id', _ORDERED + " AND status = 'O'")} AS ordered_store_num_new,
        {_d('store_id', _ORDERED + " AND status = 'P'")} AS ordered_store_num_loss
        FROM item GROUP BY dt, mall_id""",
    "sku_mall": f"SELECT dt, mall_id, cat1, cat4, sku_id, {_SKU} GROUP BY dt, mall_id, cat1, cat4, sku_id",
    "sku_day": f"""SELECT dt, mall_id, merchant_id, cat1, cat4, sku_id, {_SKU}
        GROUP BY dt, mall_id, merchant_id, cat1, cat4, sku_id""",
    "merchant_cat4": f"SELECT dt, mall_id, merchant_id, cat1, cat4, {_SKU} GROUP BY dt, mall_id, merchant_id, cat1, cat4",
    "complaint": """SELECT dt, mall_id, cat1, cat4, priority AS type_desc, SUM(amt * disc) AS refund_amt,
        COUNT(*) AS after_sale_num, COUNT(DISTINCT order_id) AS after_sale_cnt
        FROM item WHERE returnflag <> 'N' GROUP BY dt, mall_id, cat1, cat4, priority""",
    "order_day": "SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS dt FROM orders",
    "ticket": f"""SELECT store_id, mall_id, l_orderkey AS order_id,
        l_orderkey || '-' || l_linenumber AS ticket_no, l_partkey AS sku_id,
        {_MONEY.format('l_extendedprice')} * {_RATE.format('l_discount')} AS confirmed_amt,
        {_MONEY.format('l_extendedprice')} * {_RATE.format('l_tax')} AS credit_amt
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN store ON store_id = o_custkey
        WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    "goods_day": "SELECT DISTINCT dt, mall_id, sku_id, cat1, cat4 FROM item",
    "goods_card": f"""SELECT dt, mall_id, sku_id, is_up_today, is_sku_valid, standard_price, commission_rate,
        merchant_id, p_name AS sku_name, p_type AS cat1, p_brand AS cat4,
        CASE WHEN merit_raw <> 'NO' THEN merit_raw END AS merit FROM (
          SELECT CAST(l_shipdate AS DATE) AS dt, mall_id, l_partkey AS sku_id,
          MAX(l_returnflag || l_linestatus) AS merit_raw,
          MAX(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS is_up_today,
          MAX(CASE WHEN l_quantity >= 10 THEN 1 ELSE 0 END) AS is_sku_valid,
          MAX({_MONEY.format('l_extendedprice')}) AS standard_price,
          MAX({_RATE.format('l_tax')}) AS commission_rate, MAX(l_suppkey) AS merchant_id
          FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN grid ON grid_id = s_nationkey
          GROUP BY 1, 2, 3) JOIN part ON p_partkey = sku_id""",
    "flow": f"""SELECT CAST(ts AS DATE) - {EVENT_SHIFT_DAYS} AS dt, user_id AS store_id, event_type AS page,
        CAST(FLOOR(value) AS BIGINT) AS exposed_num,
        CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicked_num,
        CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS added_num,
        CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS ordered_num,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id, store.mall_id, p_type AS cat1
        FROM events JOIN store ON store.store_id = user_id
        JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)""",
    "store_dim": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt, o_custkey AS store_id, mall_id,
        grid_id, grid_name, mall_id AS province_id, mall AS province_name, grid_id // 3 AS city_id, 'CITY ' || (grid_id // 3) AS city_name,
        grid_id + 500 AS county_id, 'COUNTY ' || grid_name AS county_name,
        CASE WHEN mall <> 'ASIA' THEN grid_id + 100 END AS bd_id,
        CASE WHEN mall <> 'ASIA' THEN 'REP ' || grid_name END AS bd_name
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN grid ON grid_id = s_nationkey""",
    "agent_grid": """SELECT CAST(o_orderdate AS DATE) AS dt, mall_id, grid_id, grid_name,
        CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS status, s_suppkey AS agent_id
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN grid ON grid_id = s_nationkey""",
    "grid_day": "SELECT DISTINCT dt, grid_id, grid_name FROM item",
    "store_cat1": f"""SELECT dt, mall_id, d.store_id, cat1,
        CAST(CASE cat1 {' '.join(f"WHEN '{k}' THEN {v}" for k, v in CAT1_IDS.items())} END AS BIGINT) AS cat1_id,
        COALESCE(ordered_num, 0) AS ordered_num, COALESCE(ordered_amt, 0) AS ordered_amt, COALESCE(delivered_num, 0) AS delivered_num,
        COALESCE(delivered_amt, 0) AS delivered_amt, COALESCE(refund_amt, 0) AS refund_amt, COALESCE(refund_quality, 0) AS refund_quality,
        COALESCE(commission_amt, 0) AS commission_amt, COALESCE(natural_refund_amt, 0) AS natural_refund_amt FROM (
          SELECT * FROM (SELECT dt, store_id, cat1, {_n(_ORDERED)} AS ordered_num,
            SUM(CASE WHEN {_ORDERED} THEN amt ELSE 0 END) AS ordered_amt, COUNT(*) AS delivered_num, SUM(amt) AS delivered_amt,
            {_REFUND} AS refund_amt, {_REFUND_Q} AS refund_quality, SUM(amt * tax) AS commission_amt FROM item GROUP BY dt, store_id, cat1)
          FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS dt, o_custkey AS store_id, p_type AS cat1,
            SUM({_MONEY.format('l_extendedprice')} * {_RATE.format('l_discount')}) AS natural_refund_amt
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY 1, 2, 3)
          USING (dt, store_id, cat1)) d JOIN store ON store.store_id = d.store_id""",
    "visit_two_days": f"""SELECT dt, store_id, SUM(exposed_cnt) AS exposed_cnt, SUM(ordered_amt) AS ordered_amt, SUM(ordered_num) AS ordered_num,
        SUM(delivered_amt) AS delivered_amt, SUM(delivered_num) AS delivered_num, SUM(after_sale_num) AS after_sale_num,
        SUM(after_sale_num_quality) AS after_sale_num_quality, SUM(refund_amt) AS refund_amt, SUM(refund_quality) AS refund_quality,
        SUM(natural_refund_amt) AS natural_refund_amt, SUM(commission_amt) AS commission_amt FROM (
          SELECT dt, store_id, exposed_cnt, ordered_amt, ordered_num, delivered_amt, delivered_num, 0 AS after_sale_num, 0 AS after_sale_num_quality,
            0 AS refund_amt, 0 AS refund_quality, refund_amt AS natural_refund_amt, commission_amt FROM visit
          UNION ALL SELECT CAST(ts AS DATE) - CAST(event_id % 3 AS INTEGER), user_id, 0, 0, 0, 0, 0, 1,
            CASE WHEN {_MONEY.format('value')} > 20 THEN 1 ELSE 0 END, {_MONEY.format('value')},
            CASE WHEN {_MONEY.format('value')} > 20 THEN {_MONEY.format('value')} ELSE 0 END, 0, 0 FROM events WHERE event_type = 'error')
        GROUP BY dt, store_id""",
    "visit": f"""SELECT CAST(ts AS DATE) AS dt, user_id AS store_id,
        {_n("event_type = 'view'")} AS exposed_cnt,
        SUM(CASE WHEN event_type = 'purchase' THEN {_MONEY.format('value')} ELSE 0 END) AS ordered_amt,
        {_n("event_type = 'purchase'")} AS ordered_num,
        SUM(CASE WHEN event_type = 'click' THEN {_MONEY.format('value')} ELSE 0 END) AS delivered_amt,
        {_n("event_type = 'click'")} AS delivered_num,
        {_n("event_type = 'error'")} AS after_sale_num,
        {_n("event_type = 'error' AND value > 20")} AS after_sale_num_quality,
        SUM(CASE WHEN event_type = 'error' THEN {_MONEY.format('value')} ELSE 0 END) AS refund_amt,
        SUM(CASE WHEN event_type = 'error' AND value > 20 THEN {_MONEY.format('value')} ELSE 0 END) AS refund_quality,
        SUM(CASE WHEN event_type = 'signup' THEN {_MONEY.format('value')} ELSE 0 END) AS commission_amt
        FROM events GROUP BY 1, 2""",
    "reject": """SELECT CAST(ts AS DATE) AS dt, user_id AS goods_id, event_id
        FROM events WHERE event_type = 'error'""",
}



def with_roles(sql: str) -> str:
    """Put the definitions of the roles a statement names in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"(?:FROM|JOIN)\s+([A-Za-z_][A-Za-z_0-9]*)", text))
        for name in ROLE_SQL:
            if name in words and name not in needed:
                visit(ROLE_SQL[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({ROLE_SQL[n]})" for n in needed)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return f"{start}{ctes},\n{body[len(start):]}"
    return f"WITH {ctes}\n{body}"
