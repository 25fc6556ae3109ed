"""Joins: JON01–JON15."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import first_part, strip_digits
from ..functions.values import nz
from ..operators import joins
from ..operators.hierarchy import flatten_hierarchy
from ..operators.ranking import one_per_key_any
from ..operators.rolling import spine_expand
from ..params import DateWindow
from ..plans.reports import pricing
from ..plans.reports.common import upgrade_stat
from .registry import query
from .reports import (
    AGENTS,
    PRICE_DAY,
    PRICING_SQL,
    REGIONS_SQL,
    UPGRADE_MALL,
    pricing_tables,
    region_rows,
)
from .roles import EVENT_FIRST, EVENT_LAST, ORDER_DAYS, Roles, money


@query(
    "jon01",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey",
)
def jon01(r: Roles) -> DataFrame:
    customer = r.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return r.table("orders").select("o_orderkey", "o_custkey").join(customer, "o_custkey").drop("o_custkey")


LATE = DateWindow(ORDER_DAYS.base, -400, 0)


@query(
    "jon02",
    f"""SELECT f.dt, f.mall_id, f.cat1, CAST(f.delivered_amt AS DOUBLE) AS delivered_amt, c.ordered_store_num
    FROM mall_cat4 f LEFT JOIN mall_cat1 c ON c.dt BETWEEN DATE '{LATE.first}' AND DATE '{LATE.last}'
      AND c.dt = f.dt AND c.mall_id = f.mall_id AND c.cat1 = f.cat1""",
)
def jon02(r: Roles) -> DataFrame:
    """Left join on three keys; the right side's own window does not thin the left side."""
    from ..sources.tables import scan_window

    right = scan_window(r.mall_cat1, "dt", LATE)
    left = r.mall_cat4_with("delivered_amt").select("dt", "mall_id", "cat1", F.col("delivered_amt").cast("double").alias("delivered_amt"))
    return left.join(right, ["dt", "mall_id", "cat1"], "left")


@query(
    "jon03",
    """SELECT i.dt, i.order_id, i.sku_id, g.merit, g.is_up_today FROM item i
    LEFT JOIN goods_card g ON g.dt = i.dt AND g.mall_id = i.mall_id AND g.sku_id = i.sku_id""",
)
def jon03(r: Roles) -> DataFrame:
    """Goods of the item's own day; keys above 2 % of the items are spread first."""
    items = r.item.select("dt", "order_id", "mall_id", "sku_id")
    attributes = ["merit", "is_up_today"]
    return joins.snapshot_join(items, r.goods_card, ["mall_id", "sku_id"], attributes, hot_share=0.02).drop("mall_id")


@query(
    "jon04",
    f"""WITH {AGENTS}, place AS (SELECT dt, store_id, MAX(grid_id) AS place_id FROM store_dim GROUP BY ALL)
    SELECT f.dt, f.store_id, f.cat4, COALESCE(f.grid_id, p.place_id) AS grid_key,
      CASE WHEN a.grid_id IS NOT NULL THEN 1 ELSE 0 END AS is_agent
    FROM store_cat4 f LEFT JOIN place p ON p.dt = f.dt AND p.store_id = f.store_id
    LEFT JOIN agents a ON a.dt = f.dt AND a.mall_id = f.mall_id AND a.grid_id = COALESCE(f.grid_id, p.place_id)""",
)
def jon04(r: Roles) -> DataFrame:
    """The key comes from the fact, else from a table joined before."""
    place = r.store_dim.groupBy("dt", "store_id").agg(F.max("grid_id").alias("place_id"))
    facts = r.store_cat4.select("dt", "mall_id", "store_id", "cat4", "grid_id").join(place, ["dt", "store_id"], "left")
    agents = one_per_key_any(r.agent_grid.where("status = 1"), ["dt", "mall_id", "grid_id"]).select(
        "dt", "mall_id", F.col("grid_id").alias("grid_key"), F.lit(1).alias("agent")
    )
    joined = joins.fallback_key_join(facts, agents, "grid_key", ["grid_id", "place_id"], ["dt", "mall_id"])
    return joined.select("dt", "store_id", "cat4", "grid_key", nz("agent").alias("is_agent"))


@query(
    "jon05",
    f"""SELECT s.dt AS spine_dt, v.store_id, v.dt, v.exposed_cnt
    FROM (SELECT CAST(UNNEST(generate_series({EVENT_FIRST}, {EVENT_LAST}, INTERVAL 1 DAY)) AS DATE) AS dt) s
    JOIN visit v ON s.dt BETWEEN v.dt AND v.dt + 6""",
)
def jon05(r: Roles) -> DataFrame:
    """Facts on every spine day of their week, without a theta join."""
    visits = r.visit.select("store_id", "dt", "exposed_cnt")
    return spine_expand(visits, "dt", r.event_days, near=0, far=6)


@query(
    "jon06",
    """SELECT b.p_brand, c_custkey, c_acctbal * b.n AS score
    FROM (SELECT p_brand, COUNT(*) AS n FROM part GROUP BY p_brand) b CROSS JOIN customer""",
)
def jon06(r: Roles) -> DataFrame:
    """Products × regions, spread over blocks."""
    brands = r.table("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    customers = r.table("customer").select("c_custkey", "c_acctbal")
    grid = joins.grid_product(brands, customers)
    return grid.select("p_brand", "c_custkey", (F.col("c_acctbal") * F.col("n")).alias("score"))


@query(
    "jon07",
    f"""WITH {REGIONS_SQL},
    walk AS (SELECT t.id, t.level, t.name, t.id AS at_id, t.level AS at_level, t.name AS at_name, t.parent_id AS up FROM regions t
      UNION ALL SELECT w.id, w.level, w.name, p.id, p.level, p.name, p.parent_id
      FROM walk w JOIN regions p ON p.id = w.up AND p.level = w.at_level - 1)
    SELECT id, level, {', '.join(
        f"MAX(CASE WHEN at_level = {i} THEN at_id END) AS {n}_id, MAX(CASE WHEN at_level = {i} THEN at_name END) AS {n}_name"
        for i, n in enumerate(("province", "city", "county", "street")))} FROM walk GROUP BY id, level""".replace(
        "WITH ", "WITH RECURSIVE ", 1
    ),
)
def jon07(r: Roles) -> DataFrame:
    levels = ("province", "city", "county", "street")
    flat = flatten_hierarchy(region_rows(r), levels, "id", "parent_id", "level", "name")
    return flat.select("id", "level", *[f"{l}_{p}" for l in levels for p in ("id", "name")])


@query(
    "jon08",
    """SELECT o_orderkey, o_totalprice, p.paid FROM orders LEFT JOIN (
      SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS paid FROM lineitem
      WHERE l_linestatus <> 'O' GROUP BY l_orderkey) p ON p.l_orderkey = o_orderkey""",
)
def jon08(r: Roles) -> DataFrame:
    paid = r.table("lineitem").where("l_linestatus <> 'O'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(money("l_extendedprice")).cast("double").alias("paid")
    )
    return r.table("orders").select("o_orderkey", "o_totalprice").join(paid, "o_orderkey", "left")


@query(
    "jon09",
    """SELECT c_custkey, g.n_grids FROM customer LEFT JOIN (SELECT split_part(n_name, '_', 1) || '#' AS k, COUNT(*) AS n_grids
      FROM (SELECT mall || '_' || grid_name AS n_name FROM grid) GROUP BY 1) g
    ON g.k = regexp_replace((SELECT mall FROM store WHERE store_id = c_custkey) || '#' || c_custkey, '[0-9]', '', 'g')""",
)
def jon09(r: Roles) -> DataFrame:
    """Text keys cleaned on both sides; the right side is reduced to one row per key first."""
    grids = r.grid.select(F.concat_ws("_", "mall", "grid_name").alias("name"))
    keys = grids.groupBy(F.concat(first_part("name", "_"), F.lit("#")).alias("k")).agg(
        F.count(F.lit(1)).alias("n_grids")
    )
    named = r.store.select(
        F.col("store_id").alias("c_custkey"),
        strip_digits(F.concat_ws("#", "mall", F.col("store_id").cast("string"))).alias("k"),
    )
    return named.join(keys, "k", "left").drop("k")


@query(
    "jon10",
    "SELECT event_id, c_name FROM events JOIN customer ON c_custkey = user_id",
)
def jon10(r: Roles) -> DataFrame:
    """One side's id is padded text, the other's a number."""
    padded = r.table("events").select("event_id", F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")).alias("uid"))
    left = padded.withColumn("k", joins.harmonised("uid"))
    right = r.table("customer").select(joins.harmonised("c_custkey").alias("k"), "c_name")
    return left.join(right, "k").select("event_id", "c_name")


@query(
    "jon11",
    """SELECT c_custkey, c_name AS name_c, c_acctbal, s_acctbal, s_name AS name_s
    FROM customer FULL OUTER JOIN supplier ON s_suppkey = c_custkey""",
)
def jon11(r: Roles) -> DataFrame:
    """An outer merge by spec: renamed key columns and suffixes on clashing names."""
    pool = {
        "file:customer": r.table("customer").select("c_custkey", F.col("c_name").alias("name"), "c_acctbal"),
        "file:supplier": r.table("supplier").select("s_suppkey", F.col("s_name").alias("name"), "s_acctbal"),
    }
    spec = {
        "left": "file:customer", "right": "file:supplier", "how": "outer",
        "left_on": "c_custkey", "right_on": "s_suppkey", "suffixes": ("_c", "_s"),
    }
    return joins.declarative_merge(pool, spec).drop("s_suppkey")


@query(
    "jon12",
    """SELECT d.dt, d.n_orders, e.n_lines, f.amt FROM (SELECT CAST(o_orderdate AS DATE) AS dt, COUNT(*) AS n_orders FROM orders GROUP BY 1) d
    LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS dt, COUNT(*) AS n_lines FROM lineitem WHERE l_quantity > 45 GROUP BY 1) e ON e.dt = d.dt
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS dt, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amt
      FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f ON f.dt = d.dt""",
)
def jon12(r: Roles) -> DataFrame:
    """A report assembled from daily parts."""
    orders = r.table("orders")
    day = F.to_date("o_orderdate").alias("dt")
    count = lambda name: F.count(F.lit(1)).alias(name)
    base = orders.groupBy(day).agg(count("n_orders"))
    shipped = r.table("lineitem").where("l_quantity > 45").groupBy(F.to_date("l_shipdate").alias("dt")).agg(count("n_lines"))
    done = orders.where("o_orderstatus = 'F'").groupBy(day).agg(F.sum(money("o_totalprice")).cast("double").alias("amt"))
    return base.join(shipped, "dt", "left").join(done, "dt", "left")


@query(
    "jon13",
    f"""WITH {PRICING_SQL} SELECT c_custkey, r.goods_id, r.trial_group,
      CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN r.agent_rate ELSE r.self_rate END AS rate
    FROM customer JOIN rates r ON r.city_id = c_nationkey""",
)
def jon13(r: Roles) -> DataFrame:
    """Rates by product and city; the operation type selects which of the two applies."""
    t = pricing_tables(r)
    rates = pricing.active_rates(t["trial_rate"], PRICE_DAY, "seq")
    joined = t["county"].join(rates, "city_id")
    rate = F.when(F.instr("operation_type", "self") > 0, F.col("self_rate")).when(
        F.instr("operation_type", "agent") > 0, F.col("agent_rate")
    )
    return joined.select(F.col("region_id").alias("c_custkey"), "goods_id", "trial_group", rate.alias("rate"))


@query(
    "jon14",
    """SELECT event_id, COALESCE(CASE WHEN event_type <> 'click' AND user_id IN (7, 8, 9)
        THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END, value) AS rate FROM events""",
)
def jon14(r: Roles) -> DataFrame:
    """The JSON map holds the key for some users only, and is malformed for clicks."""
    key = F.when(F.col("user_id").isin(7, 8, 9), "k").otherwise("other")
    broken = F.when(F.col("event_type") == "click", F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    rate = joins.override_rate(broken, key, F.col("value"))
    return r.table("events").select("event_id", rate.alias("rate"))


@query(
    "jon15",
    f"""WITH {UPGRADE_MALL} SELECT dt, mall_id, cat1, cat4, upgrade_tickets,
    CAST(upgrade_refund AS DOUBLE) AS upgrade_refund, CAST(upgrade_platform_refund AS DOUBLE) AS upgrade_platform_refund FROM upgrade""",
)
def jon15(r: Roles) -> DataFrame:
    stat = upgrade_stat(r.ticket, r.orders, r.goods_day, r.order_days)
    return stat.withColumns({c: F.col(c).cast("double") for c in ("upgrade_refund", "upgrade_platform_refund")})
