"""Window functions: WIN01–WIN09."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.values import raw_ratio
from ..operators import ranking
from ..operators.events import latest_status
from ..operators.metrics import Metrics, aggregate
from ..operators.rolling import Band, repeat_entities, rolling_by_spine
from ..plans.reports.common import ranked_cat4
from ..plans.reports.malls import card_updates
from .registry import query
from .reports import ALL_CARD_UPDATES
from .roles import EVENT_FIRST, EVENT_LAST, Roles

SPINE = f"""(SELECT CAST(UNNEST(generate_series({EVENT_FIRST}, {EVENT_LAST}, INTERVAL 1 DAY)) AS DATE) AS dt)"""


@query(
    "win01",
    """SELECT f.dt, f.cat1, f.cat4, f.mall_id,
      ROW_NUMBER() OVER (w ORDER BY COALESCE(f.delivered_amt, 0) DESC, f.mall_id) AS delivered_amt_rank,
      ROW_NUMBER() OVER (w ORDER BY COALESCE(CAST(f.ordered_store_num AS DOUBLE) / NULLIF(c.ordered_store_num, 0), 0) DESC, f.mall_id) AS penetration_rank,
      ROW_NUMBER() OVER (w ORDER BY COALESCE(CAST(f.ordered_store_num AS DOUBLE) / NULLIF(d.ordered_store_num, 0), 0) DESC, f.mall_id) AS dau_rank
    FROM mall_cat4 f LEFT JOIN mall_cat1 c ON c.dt = f.dt AND c.mall_id = f.mall_id AND c.cat1 = f.cat1
    LEFT JOIN mall_day d ON d.dt = f.dt AND d.mall_id = f.mall_id WINDOW w AS (PARTITION BY f.cat1, f.cat4, f.dt)""",
)
def win01(r: Roles) -> DataFrame:
    """Three ranks of malls inside a category-day, from one shuffle."""
    r = r.stored(r.order_days)
    ranked = ranked_cat4(r.mall_cat4_with("delivered_amt", "ordered_store_num"), r.mall_cat1, r.mall_day, r.mall, r.order_days, None)
    ranks = ("delivered_amt_rank", "penetration_rank", "dau_rank")
    return ranked.select("dt", "cat1", "cat4", "mall_id", *[F.col(c).cast("bigint").alias(c) for c in ranks])


@query(
    "win02",
    """SELECT o_custkey, o_orderpriority, share, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY COALESCE(share, 0) DESC, o_orderpriority) AS pos
    FROM (SELECT o_custkey, o_orderpriority, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE)
      / NULLIF(COUNT(*) FILTER (WHERE o_orderstatus <> 'P'), 0) AS share FROM orders GROUP BY ALL)""",
)
def win02(r: Roles) -> DataFrame:
    """Rank by a ratio that may be null."""
    n = lambda cond: F.count(F.when(cond, 1))
    status = F.col("o_orderstatus")
    per = r.table("orders").groupBy("o_custkey", "o_orderpriority").agg(
        n(status == "F").alias("done"), n(status != "P").alias("kept")
    )
    shares = per.select("o_custkey", "o_orderpriority", raw_ratio("done", "kept").alias("share"))
    return shares.withColumn("pos", ranking.rank_desc(["o_custkey"], "share", ["o_orderpriority"]).cast("bigint"))


@query("win03", "SELECT DISTINCT dt, mall_id, grid_id FROM agent_grid WHERE status = 1")
def win03(r: Roles) -> DataFrame:
    """One row per key where upstream numbers rows without an order."""
    return ranking.one_per_key_any(r.agent_grid.where("status = 1"), ["dt", "mall_id", "grid_id"])


@query("win04", f"WITH {ALL_CARD_UPDATES} SELECT * FROM updates")
def win04(r: Roles) -> DataFrame:
    return card_updates(r.goods_card, r.ship_days)


MEASURES = ["exposed_cnt", "delivered_num", "after_sale_num"]
BANDS = [Band("d30", 0, 29), Band("d14", 0, 13), Band("d7", 0, 6), Band("p7", 7, 13)]


def _rolled_sql(direction: str) -> str:
    gap = "s.dt - v.dt" if direction == "backward" else "v.dt - s.dt"
    cols = [f"CAST(SUM(CASE WHEN v.dt = s.dt THEN {m} ELSE 0 END) AS BIGINT) AS {m}" for m in MEASURES]
    cols += [
        f"CAST(SUM(CASE WHEN {gap} BETWEEN {b.near} AND {b.far} THEN {m} ELSE 0 END) AS BIGINT) AS {m}_{b.name}"
        for b in BANDS for m in MEASURES
    ]
    return f"""SELECT '{direction}' AS direction, s.dt, v.store_id, {', '.join(cols)}
      FROM {SPINE} s JOIN visit v ON {gap} BETWEEN 0 AND 29 GROUP BY s.dt, v.store_id"""


@query("win05", f"{_rolled_sql('backward')} UNION ALL {_rolled_sql('forward')}")
def win05(r: Roles) -> DataFrame:
    """Rolling sums over four bands, looking back and looking ahead."""
    parts = [
        rolling_by_spine(r.visit, ["store_id"], "dt", r.event_days, MEASURES, BANDS, direction=d).withColumn("direction", F.lit(d))
        for d in ("backward", "forward")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "win06",
    f"""SELECT s.dt, v.store_id, COUNT(DISTINCT CASE WHEN v.dt > s.dt - 7 AND exposed_cnt > 0 THEN v.dt END) AS exposed_d7,
    COUNT(DISTINCT CASE WHEN exposed_cnt > 0 THEN v.dt END) AS exposed_d30,
    COUNT(DISTINCT CASE WHEN v.dt > s.dt - 7 AND ordered_num > 0 THEN v.dt END) AS ordered_d7,
    COUNT(DISTINCT CASE WHEN ordered_num > 0 THEN v.dt END) AS ordered_d30
    FROM {SPINE} s JOIN visit v ON v.dt BETWEEN s.dt - 29 AND s.dt GROUP BY s.dt, v.store_id""",
)
def win06(r: Roles) -> DataFrame:
    """Rolling distinct active days."""
    active = {"exposed": F.col("exposed_cnt") > 0, "ordered": F.col("ordered_num") > 0}
    return rolling_by_spine(
        r.visit, ["store_id"], "dt", r.event_days, [], [Band("d7", 0, 6), Band("d30", 0, 29)], active
    )


@query(
    "win07",
    """SELECT d.dt, (SELECT COUNT(*) FROM (SELECT goods_id FROM reject x WHERE x.dt BETWEEN d.dt - 6 AND d.dt
      GROUP BY goods_id HAVING COUNT(DISTINCT x.dt) > 1)) AS n_repeat FROM (SELECT DISTINCT dt FROM reject) d""",
)
def win07(r: Roles) -> DataFrame:
    return repeat_entities(r.reject, "dt", "goods_id")


@query(
    "win08",
    """SELECT mall_id, cat1, COUNT(DISTINCT CASE WHEN share >= 0.15 AND pos <= 3 THEN cat4 END) AS n_top FROM (
      SELECT f.dt, f.mall_id, f.cat1, f.cat4, CAST(f.ordered_store_num AS DOUBLE) / NULLIF(c.ordered_store_num, 0) AS share,
        ROW_NUMBER() OVER (PARTITION BY f.cat1, f.cat4, f.dt
          ORDER BY COALESCE(CAST(f.ordered_store_num AS DOUBLE) / NULLIF(c.ordered_store_num, 0), 0) DESC, f.mall_id) AS pos
      FROM mall_cat4 f LEFT JOIN mall_cat1 c ON c.dt = f.dt AND c.mall_id = f.mall_id AND c.cat1 = f.cat1) GROUP BY mall_id, cat1""",
)
def win08(r: Roles) -> DataFrame:
    """A rank gate inside a conditional distinct count."""
    r = r.stored(r.order_days)
    ranked = ranked_cat4(r.mall_cat4_with("delivered_amt", "ordered_store_num"), r.mall_cat1, r.mall_day, r.mall, r.order_days, None)
    share = raw_ratio("ordered_store_num", "cat1_stores")
    gate = (share >= 0.15) & (F.col("penetration_rank") <= 3)
    return aggregate(ranked, ["mall_id", "cat1"], Metrics(distincts={"n_top": ("cat4", gate)}))


@query(
    "win09",
    """SELECT user_id, event_type, event_id FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def win09(r: Roles) -> DataFrame:
    """Last write wins per key."""
    log = r.table("events").select("user_id", "event_type", "ts", "event_id")
    return latest_status(log, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


