"""Aggregations: AGG01–AGG17."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.values import flag, nz, ratio
from ..operators import metrics
from ..operators.events import status_summary
from ..operators.metrics import Metrics, aggregate
from ..operators.ranking import one_per_key
from ..operators.rolling import spine_expand
from ..plans.reports.common import target_skus
from ..plans.reports.fusion import pilot_kpis, quality_rejects
from .registry import query
from .reports import (
    DETAIL,
    MARKS_SQL,
    PILOT_COLUMNS,
    PILOT_FLAGS,
    PILOT_SQL,
    Q16_COUNTS,
    Q16_MONEY,
    RULES,
    pilot_flags,
    q06,
)
from .roles import EVENT_FIRST, EVENT_LAST, HOME_MALL, QUALITY_TYPES, Roles, _list, refund, refund_quality


@query(
    "agg01",
    """SELECT dt, mall_id, cat1, CAST(SUM(amt) AS DOUBLE) AS amt, CAST(SUM(qty) AS DOUBLE) AS qty, COUNT(*) AS n
    FROM item GROUP BY dt, mall_id, cat1""",
)
def agg01(r: Roles) -> DataFrame:
    return r.item.groupBy("dt", "mall_id", "cat1").agg(
        F.sum("amt").cast("double").alias("amt"), F.sum("qty").cast("double").alias("qty"), F.count(F.lit(1)).alias("n")
    )


@query("agg02", "SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_suppkey")
def agg02(r: Roles) -> DataFrame:
    return aggregate(r.table("lineitem"), ["l_suppkey"], Metrics(distincts={"n_orders": ("l_orderkey", None)}))


@query(
    "agg03",
    """SELECT cat4, COUNT(DISTINCT CASE WHEN returnflag = 'R' THEN store_id END) AS r_stores,
    COUNT(DISTINCT CASE WHEN returnflag = 'A' AND qty > 25 THEN store_id END) AS a_stores,
    COUNT(DISTINCT CASE WHEN linestatus = 'O' THEN store_id END) AS o_stores,
    COUNT(DISTINCT CASE WHEN disc >= 0.05 THEN store_id END) AS d_stores,
    COUNT(DISTINCT CASE WHEN qty > 45 THEN sku_id END) AS big_skus, CAST(SUM(amt) AS DOUBLE) AS amt FROM item GROUP BY cat4""",
)
def agg03(r: Roles) -> DataFrame:
    """Five conditional distinct counts over two entities, and a sum."""
    store = lambda cond: ("store_id", cond)
    result = aggregate(
        r.item,
        ["cat4"],
        Metrics(
            sums={"amt": F.col("amt")},
            distincts={
                "r_stores": store(F.col("returnflag") == "R"),
                "a_stores": store((F.col("returnflag") == "A") & (F.col("qty") > 25)),
                "o_stores": store(F.col("linestatus") == "O"),
                "d_stores": store(F.col("disc") >= 0.05),
                "big_skus": ("sku_id", F.col("qty") > 45),
            },
        ),
    )
    return result.withColumn("amt", F.col("amt").cast("double"))


@query(
    "agg04",
    f"""SELECT dt, mall_id, CAST(SUM(CASE WHEN returnflag = 'R' THEN amt * disc ELSE 0 END) AS DOUBLE) AS refund,
    CAST(SUM(CASE WHEN returnflag = 'R' AND priority IN ({_list(QUALITY_TYPES)}) THEN amt * disc ELSE 0 END) AS DOUBLE) AS refund_quality,
    CAST(SUM((CASE WHEN linestatus = 'O' THEN 1 ELSE 0 END) * amt) AS DOUBLE) AS open_amt FROM item GROUP BY dt, mall_id""",
)
def agg04(r: Roles) -> DataFrame:
    sums = {
        "refund": refund(),
        "refund_quality": refund_quality(),
        "open_amt": flag(F.col("linestatus") == "O") * F.col("amt"),
    }
    result = aggregate(r.item, ["dt", "mall_id"], Metrics(sums=sums))
    return result.withColumns({c: F.col(c).cast("double") for c in sums})


@query(
    "agg05",
    """SELECT source, CAST(SUM(COALESCE(quality, 0) + COALESCE(toxic, 0)) AS BIGINT) AS marks
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
)
def agg05(r: Roles) -> DataFrame:
    """Null-safe sum of terms: a row without labels adds 0, not null."""
    rows = r.table("documents").select("doc_id", "source").join(r.table("labels"), "doc_id", "left")
    return rows.groupBy("source").agg(F.sum(nz("quality") + nz("toxic")).alias("marks"))


def _pick(null_other: bool) -> str:
    other = f"COALESCE(m, -99) <> {HOME_MALL}" if null_other else f"m <> {HOME_MALL}"
    side = "null_is_other" if null_other else "null_is_neither"
    cols = ", ".join(
        f"COALESCE(MAX(CASE WHEN m = {HOME_MALL} THEN {c} END), MAX(CASE WHEN {other} THEN {c} END)) AS {c}"
        for c in ("grid_name", "province_name")
    )
    return f"SELECT '{side}' AS variant, dt, store_id, {cols} FROM dim GROUP BY dt, store_id"


@query(
    "agg06",
    f"""WITH dim AS (SELECT *, CASE WHEN mall_id <> 4 THEN mall_id END AS m FROM store_dim)
    {_pick(True)} UNION ALL {_pick(False)}""",
)
def agg06(r: Roles) -> DataFrame:
    """The home mall's attribute, else another mall's; both readings of an unknown mall."""
    dim = r.store_dim.withColumn("m", F.when(F.col("mall_id") != 4, F.col("mall_id")))
    attributes, home = ["grid_name", "province_name"], F.col("m") == HOME_MALL
    picks = [
        metrics.pick_preferred(dim, ["dt", "store_id"], attributes, home, null_other).withColumn("variant", F.lit(name))
        for name, null_other in (("null_is_other", True), ("null_is_neither", False))
    ]
    return picks[0].unionByName(picks[1])


@query(
    "agg07",
    f"""SELECT s.dt, v.store_id, CAST(MAX(CASE WHEN v.dt = s.dt THEN exposed_cnt ELSE 0 END) AS BIGINT) AS exposed_cnt,
    CAST(MAX(CASE WHEN v.dt = s.dt THEN ordered_amt ELSE 0 END) AS DOUBLE) AS ordered_amt
    FROM (SELECT CAST(UNNEST(generate_series({EVENT_FIRST}, {EVENT_LAST}, INTERVAL 1 DAY)) AS DATE) AS dt) s
    JOIN visit v ON v.dt BETWEEN s.dt - 13 AND s.dt GROUP BY s.dt, v.store_id""",
)
def agg07(r: Roles) -> DataFrame:
    """The day's own value inside a rolling group; days without facts read 0."""
    spread = spine_expand(r.visit, "dt", r.event_days, near=0, far=13, out="day")
    same = F.col("day") == F.col("dt")
    own = lambda c: F.max(F.when(same, F.col(c)).otherwise(0))
    return spread.groupBy(F.col("day").alias("dt"), "store_id").agg(
        own("exposed_cnt").alias("exposed_cnt"), own("ordered_amt").cast("double").alias("ordered_amt")
    )


@query(
    "agg08",
    """SELECT cat1, cat4, ROUND(COALESCE(CAST(SUM(CASE WHEN returnflag = 'R' THEN amt * disc ELSE 0 END) AS DOUBLE)
      / NULLIF(CAST(SUM(amt) AS DOUBLE), 0), 0), 5) AS refund_rate,
    ROUND(COALESCE(CAST(SUM(CASE WHEN qty > 49 AND disc = 0 AND tax = 0 THEN amt ELSE 0 END) AS DOUBLE)
      / NULLIF(CAST(SUM(CASE WHEN qty > 49 AND tax = 0 THEN amt ELSE 0 END) AS DOUBLE), 0), 0), 4) AS odd_share
    FROM item GROUP BY cat1, cat4""",
)
def agg08(r: Roles) -> DataFrame:
    """Ratios of sums; an empty denominator gives 0."""
    odd = (F.col("qty") > 49) & (F.col("tax") == 0)
    term = Metrics.when_sum
    sums = {
        "refund": refund(),
        "amt": F.col("amt"),
        "odd": term(odd & (F.col("disc") == 0), F.col("amt")),
        "base": term(odd, F.col("amt")),
    }
    stat = aggregate(r.item, ["cat1", "cat4"], Metrics(sums=sums))
    return stat.select(
        "cat1", "cat4", ratio("refund", "amt").alias("refund_rate"), ratio("odd", "base", 4).alias("odd_share")
    )


@query(
    "agg09",
    """SELECT s.dt, s.mall_id, s.cat1, s.cat4, COUNT(DISTINCT CASE WHEN CAST(s.ordered_store_num AS DOUBLE)
      / NULLIF(c.ordered_store_num, 0) >= 0.1 THEN sku_id END) AS target_sku_num
    FROM sku_mall s LEFT JOIN mall_cat1 c ON c.dt = s.dt AND c.mall_id = s.mall_id AND c.cat1 = s.cat1
    GROUP BY ALL HAVING target_sku_num > 0""",
)
def agg09(r: Roles) -> DataFrame:
    return target_skus(r.sku_mall, r.mall_cat1, RULES, r.order_days)


@query(
    "agg10",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
    FROM orders GROUP BY o_custkey""",
)
def agg10(r: Roles) -> DataFrame:
    """Distinct values as a sorted set."""
    unique = r.table("orders").select("o_custkey", "o_orderpriority").distinct()
    return unique.groupBy("o_custkey").agg(
        F.array_join(F.sort_array(F.collect_list("o_orderpriority")), ",").alias("priorities")
    )


@query(
    "agg11",
    """SELECT user_id, string_agg(event_type || '=' || days, ';' ORDER BY event_type) AS items FROM (
      SELECT user_id, event_type, string_agg(DISTINCT d, ',' ORDER BY d) AS days FROM (
        SELECT user_id, event_type, strftime(ts, '%Y-%m-%d') AS d FROM events) GROUP BY ALL) GROUP BY user_id""",
)
def agg11(r: Roles) -> DataFrame:
    """Map of sorted distinct lists, printed."""
    rows = r.table("events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("d"))
    maps = metrics.collect_map(rows, ["user_id"], "event_type", "d")
    entry = lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))
    return maps.select("user_id", F.array_join(F.transform(F.map_entries("items"), entry), ";").alias("items"))


@query(
    "agg12",
    """SELECT 'day' AS grouping, dt, CAST(NULL AS VARCHAR) AS page, COUNT(store_id) AS n_rejects, COUNT(DISTINCT store_id) AS n_reject_goods
    FROM flow GROUP BY dt UNION ALL
    SELECT 'day and page', dt, page, COUNT(store_id), COUNT(DISTINCT store_id) FROM flow GROUP BY dt, page""",
)
def agg12(r: Roles) -> DataFrame:
    """The same counts under two groupings."""
    rows = r.flow.withColumnRenamed("store_id", "goods_id")
    by_day = quality_rejects(rows).drop("n_repeat_7d").withColumn("grouping", F.lit("day"))
    by_page = quality_rejects(rows, ["dt", "page"]).withColumn("grouping", F.lit("day and page"))
    return by_page.unionByName(by_day, allowMissingColumns=True)


@query("agg13", f"WITH {DETAIL}, {MARKS_SQL}, {PILOT_SQL} SELECT p.dt, {PILOT_COLUMNS} FROM pilot p")
def agg13(r: Roles) -> DataFrame:
    stat = pilot_kpis(q06(r), pilot_flags(r), PILOT_FLAGS, RULES)
    return stat.withColumns({n: F.col(n).cast("double") for n in Q16_MONEY}).withColumns(
        {n: F.col(n).cast("bigint") for n in Q16_COUNTS}
    )


@query(
    "agg14",
    """SELECT user_id, COUNT(DISTINCT CASE WHEN CAST(ts AS DATE) > DATE '2024-01-15' AND event_type = 'purchase'
      THEN CAST(ts AS DATE) END) AS late_days, COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS all_days
    FROM events GROUP BY user_id""",
)
def agg14(r: Roles) -> DataFrame:
    """Distinct active days, by condition."""
    day, bought = F.to_date("ts"), F.col("event_type") == "purchase"
    late = bought & (day > F.lit("2024-01-15").cast("date"))
    rows = r.table("events").withColumn("day", day)
    return aggregate(rows, ["user_id"], Metrics(distincts={"late_days": ("day", late), "all_days": ("day", bought)}))


def _kept(side: str, direction: str) -> str:
    return f"""SELECT '{side}' AS kept, l_partkey, l_suppkey, l_quantity FROM lineitem
    QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey
      ORDER BY l_shipdate {direction}, l_orderkey {direction}, l_linenumber {direction}, l_quantity {direction}) = 1"""


@query("agg15", f"{_kept('first', 'ASC')} UNION ALL {_kept('last', 'DESC')}")
def agg15(r: Roles) -> DataFrame:
    """First and last row per key in a total order."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]
    lines = r.table("lineitem").select("l_partkey", "l_suppkey", *order)
    parts = [
        one_per_key(lines, ["l_partkey", "l_suppkey"], order, last=(side == "last")).select(
            F.lit(side).alias("kept"), "l_partkey", "l_suppkey", "l_quantity"
        )
        for side in ("first", "last")
    ]
    return parts[0].unionByName(parts[1])


@query("agg16", "SELECT MIN(CAST(l_shipdate AS DATE)) AS first, MAX(CAST(l_shipdate AS DATE)) AS last FROM lineitem")
def agg16(r: Roles) -> DataFrame:
    span = metrics.day_range(r.table("lineitem"), "l_shipdate")
    return span.select(F.to_date("first").alias("first"), F.to_date("last").alias("last"))


@query(
    "agg17",
    """SELECT 'write_' || COALESCE(CASE WHEN event_type <> 'error' THEN event_type END, 'unknown') AS kind_status, COUNT(*) AS n
    FROM events GROUP BY 1""",
)
def agg17(r: Roles) -> DataFrame:
    log = r.table("events").select(
        F.lit("write").alias("kind"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("status")
    )
    return status_summary(log, "kind", "status")
