"""The trial aggregates over the supplied tables: X01 to X05.

Stand-ins: sku = part type, region = nation, city unit = nations that share a remainder of
eight, stage days from 1995 on. Configuration rows come from the tables where they have one.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions.values import flag
from ..operators.calendar import stage_calendar
from ..params import DateWindow
from ..plans.reports import trial
from ..sources.tables import scan_window
from .registry import query
from .roles import CANCELLED, Roles, money, rate

SKUS = ["ECONOMY", "PROMO", "STANDARD"]
UNTIL = date(1996, 3, 20)
STAGES = [
    ("prepare", date(1995, 1, 1), date(1995, 2, 28), "day"),
    ("baseline", date(1995, 3, 1), date(1995, 6, 30), "whole"),
    ("effect", date(1995, 7, 1), date(1996, 3, 31), "week"),
]
TRIAL_DAYS = DateWindow.of_days(STAGES[0][1], UNTIL)
HISTORY = [date(1997, 1, 6), date(1997, 1, 13), date(1997, 2, 3), date(1997, 2, 10)]
FALLBACK = DateWindow.of_days(STAGES[0][1], STAGES[1][2])
#: Target rates by stage and group; the type of region decides before the trial.
TARGETS = {"prepare": {"self": 0.075, "agent": 0.046}, "baseline": {"self": 0.075, "agent": 0.046}}
GROUP_TARGETS = {"G0": 0.06, "G1": 0.05, "G2": 0.03, "G3": 0.02}
RULES = trial.TrialRules()

_ITEMS = """SELECT l_orderkey || '-' || l_linenumber AS order_item_id, o_custkey AS store_id,
    CAST(o_orderdate AS DATE) AS dt, CAST(c_nationkey AS BIGINT) AS region_id, p_type AS sku_id,
    CAST(l_quantity AS DECIMAL(12,2)) AS ordered_num,
    CAST(l_quantity AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2))) AS delivered_num,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS delivered_amt,
    CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS commission_amt,
    CAST(p_retailprice AS DECIMAL(12,2)) * p_size AS list_price,
    CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS is_valid
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey"""


def trial_facts(r: Roles) -> DataFrame:
    """Order items; what was delivered may be less or more than what was ordered."""
    lines = r.table("lineitem").select(
        "l_orderkey", "l_partkey", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
        money("l_quantity").alias("ordered_num"),
        (money("l_quantity") * (F.lit(1) - rate("l_discount") + rate("l_tax"))).alias("delivered_num"),
        money("l_extendedprice").alias("delivered_amt"),
        (money("l_extendedprice") * rate("l_tax")).alias("commission_amt"),
    )
    orders = r.table("orders").select(
        "o_orderkey", F.col("o_custkey").alias("store_id"), F.to_date("o_orderdate").alias("dt"),
        flag(F.col("o_orderstatus") != CANCELLED).alias("is_valid"),
    )
    stores = r.table("customer").select(F.col("c_custkey").alias("store_id"), F.col("c_nationkey").cast("bigint").alias("region_id"))
    parts = r.table("part").select(
        "p_partkey", F.col("p_type").alias("sku_id"), (money("p_retailprice") * F.col("p_size")).alias("list_price")
    )
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(stores, "store_id")
    return rows.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("l_orderkey", "o_orderkey", "l_partkey", "p_partkey")


def design(r: Roles) -> DataFrame:
    """Nations as regions: eight city units, four groups, every other unit agent-run; one nation stays out."""
    unit = F.col("n_nationkey") % 8
    return r.table("nation").select(
        F.col("n_nationkey").cast("bigint").alias("region_id"),
        F.concat(F.lit("CITY_"), unit.cast("string")).alias("city_unit"),
        F.when((unit % 2 == 1) & (F.col("n_nationkey") != 17), "agent").otherwise("self").alias("region_type"),
        F.concat(F.lit("G"), (unit % 4).cast("string")).alias("trial_group"),
        flag(F.col("n_nationkey") != 24).alias("in_trial"),
    )


def stages(r: Roles) -> DataFrame:
    return r.spark.createDataFrame(STAGES, "stage string, first date, last date, grain string")


def holidays(r: Roles) -> DataFrame:
    """Days of orders that fall on the holiday."""
    day = F.to_date("o_orderdate")
    rows = scan_window(r.table("orders"), "o_orderdate", TRIAL_DAYS)
    return rows.select(day.alias("day")).where(F.date_format("day", "MM-dd").isin("06-19", "06-20", "06-21")).distinct()


def calendar(r: Roles) -> DataFrame:
    return stage_calendar(stages(r), holidays(r), UNTIL)


def rates(r: Roles) -> DataFrame:
    """Target rates per stage, group and type of region."""
    of_type = [(s, g, t, v) for s, types in TARGETS.items() for g in GROUP_TARGETS for t, v in types.items()]
    of_group = [("effect", g, t, v) for g, v in GROUP_TARGETS.items() for t in ("self", "agent")]
    return r.spark.createDataFrame(of_type + of_group, "stage string, trial_group string, region_type string, rate double")


def goods(r: Roles) -> DataFrame:
    return r.table("part").groupBy(F.col("p_type").alias("sku_id")).agg(
        F.min("p_brand").alias("sku_origin"), F.max("p_brand").alias("sku_grade"), F.max("p_size").alias("sku_weight_spec")
    )


def wide(r: Roles) -> DataFrame:
    return trial.wide_table(trial_facts(r), calendar(r), design(r), rates(r), goods(r), SKUS, TRIAL_DAYS)


def _rows(rows: list[tuple], names: str) -> str:
    spell = lambda v: f"DATE '{v}'" if isinstance(v, date) else f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
    values = ", ".join("(" + ", ".join(map(spell, row)) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {values}) AS t({names}))"


_SKU_LIST = ", ".join(f"'{s}'" for s in SKUS)
_RATE_ROWS = [(s, g, t, v) for s, types in TARGETS.items() for g in GROUP_TARGETS for t, v in types.items()]
_RATE_ROWS += [("effect", g, t, v) for g, v in GROUP_TARGETS.items() for t in ("self", "agent")]
_DESIGN = """SELECT CAST(n_nationkey AS BIGINT) AS region_id, 'CITY_' || (n_nationkey % 8) AS city_unit,
    CASE WHEN n_nationkey % 2 = 1 AND n_nationkey <> 17 THEN 'agent' ELSE 'self' END AS region_type,
    'G' || (n_nationkey % 4) AS trial_group FROM nation WHERE n_nationkey <> 24"""
_HOLIDAYS = f"""SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE strftime(o_orderdate, '%m-%d') IN ('06-19', '06-20', '06-21')"""
_TRADING = "CAST((SELECT COUNT(*) FROM generate_series({0}, least({1}, DATE '" + str(UNTIL) + """'), INTERVAL 1 DAY) g(d)
    WHERE CAST(d AS DATE) NOT IN (SELECT day FROM holidays)) AS INTEGER)"""
#: Weeks of the last stage, by arithmetic on their number.
_EFFECT_FIRST, _EFFECT_LAST = STAGES[2][1], STAGES[2][2]
_TRIAL = f"""design AS ({_DESIGN}), holidays AS ({_HOLIDAYS}), targets AS {_rows(_RATE_ROWS, 'stage, trial_group, region_type, target_r0')},
    city AS (SELECT city_unit, MAX(region_type) AS city_type FROM design GROUP BY city_unit),
    goods AS (SELECT p_type AS sku_id, MIN(p_brand) AS sku_origin, MAX(p_brand) AS sku_grade, MAX(p_size) AS sku_weight_spec FROM part GROUP BY p_type),
    sold AS (SELECT f.*, city_unit, region_type, trial_group, city_type FROM ({_ITEMS}) f JOIN design USING (region_id) JOIN city USING (city_unit)
      WHERE is_valid = 1 AND sku_id IN ({_SKU_LIST}) AND dt <= DATE '{UNTIL}'),
    weeks AS (SELECT *, 'effect' AS stage, DATE '{_EFFECT_FIRST}' + CAST(7 * ((dt - DATE '{_EFFECT_FIRST}') // 7) AS INTEGER) AS period_first
      FROM sold WHERE dt BETWEEN DATE '{_EFFECT_FIRST}' AND DATE '{_EFFECT_LAST}')"""
_MEASURES = """COUNT(DISTINCT order_item_id) AS order_count, COUNT(DISTINCT store_id) AS active_store_count,
    CAST(SUM(delivered_amt) AS DOUBLE) AS gmv, CAST(SUM(commission_amt) AS DOUBLE) AS commission_amount,
    CAST(SUM(CASE WHEN ordered_num > delivered_num THEN ordered_num - delivered_num ELSE 0 END) AS DOUBLE) AS stockout_num,
    CAST(SUM(list_price) AS DOUBLE) / COUNT(list_price) AS price"""


def _grain(level: str, stage: str, rows: str, first: str, sku: str, region_type: str, by: str) -> str:
    return f"""SELECT '{level}' AS level, '{stage}' AS stage, {first} AS period_first, city_unit, {region_type} AS region_type,
      trial_group, {sku} AS sku_id, {_MEASURES} FROM {rows} GROUP BY {by}"""


_PREPARE = f"(SELECT * FROM sold WHERE dt BETWEEN DATE '{STAGES[0][1]}' AND DATE '{STAGES[0][2]}')"
_BASELINE = f"(SELECT * FROM sold WHERE dt BETWEEN DATE '{STAGES[1][1]}' AND DATE '{STAGES[1][2]}')"
_GRAINS = " UNION ALL ".join(
    [
        _grain("city", "prepare", _PREPARE, "dt", "CAST(NULL AS VARCHAR)", "region_type", "dt, city_unit, region_type, trial_group"),
        _grain("sku", "baseline", _BASELINE, f"DATE '{STAGES[1][1]}'", "sku_id", "city_type", "city_unit, city_type, trial_group, sku_id"),
        _grain("city", "baseline", _BASELINE, f"DATE '{STAGES[1][1]}'", "CAST(NULL AS VARCHAR)", "city_type", "city_unit, city_type, trial_group"),
        _grain("sku", "effect", "weeks", "period_first", "sku_id", "city_type", "period_first, city_unit, city_type, trial_group, sku_id"),
        _grain("city", "effect", "weeks", "period_first", "CAST(NULL AS VARCHAR)", "city_type", "period_first, city_unit, city_type, trial_group"),
    ]
)
_IN_STAGE = f"""CASE stage WHEN 'effect' THEN period_first + 6 <= least(DATE '{_EFFECT_LAST}', DATE '{UNTIL}') END"""
_PERIOD_LAST = f"""CASE stage WHEN 'prepare' THEN period_first WHEN 'baseline' THEN DATE '{STAGES[1][2]}'
    ELSE least(period_first + 6, DATE '{_EFFECT_LAST}') END"""
_WIDE = f"""{_TRIAL}, grains AS ({_GRAINS}),
    wide AS (SELECT level, stage, CASE stage WHEN 'effect' THEN 'effect_W' || (1 + (period_first - DATE '{_EFFECT_FIRST}') // 7) END AS stage_week,
      period_first, {_IN_STAGE} AS is_complete_week, {_TRADING.format('period_first', _PERIOD_LAST)} AS trading_days,
      city_unit, region_type, trial_group, sku_id, sku_origin, sku_grade, sku_weight_spec, order_count, active_store_count, gmv,
      commission_amount, stockout_num, ROUND(commission_amount / NULLIF(gmv, 0), 6) AS commission_rate,
      ROUND(price * (1 - commission_amount / NULLIF(gmv, 0)), 4) AS supply_price, target_r0
      FROM grains LEFT JOIN targets USING (stage, trial_group, region_type) LEFT JOIN goods USING (sku_id))"""


@query("x01", f"WITH {_WIDE} SELECT * FROM wide")
def x01(r: Roles) -> DataFrame:
    return wide(r)


@query(
    "x02",
    f"""WITH holidays AS ({_HOLIDAYS}), periods AS (
      SELECT 'prepare' AS stage, CAST(d AS DATE) AS period_first, CAST(NULL AS INTEGER) AS week_no
        FROM generate_series(DATE '{STAGES[0][1]}', DATE '{STAGES[0][2]}', INTERVAL 1 DAY) g(d)
      UNION ALL SELECT 'baseline', DATE '{STAGES[1][1]}', NULL
      UNION ALL SELECT 'effect', CAST(d AS DATE), CAST(1 + (CAST(d AS DATE) - DATE '{_EFFECT_FIRST}') // 7 AS INTEGER)
        FROM generate_series(DATE '{_EFFECT_FIRST}', DATE '{_EFFECT_LAST}', INTERVAL 7 DAY) g(d)),
    laid AS (SELECT *, CAST({_PERIOD_LAST} AS DATE) AS period_last, {_IN_STAGE} AS is_complete_week FROM periods)
    SELECT stage, CASE WHEN week_no IS NOT NULL THEN 'effect_W' || week_no END AS stage_week, week_no, period_first, period_last,
      is_complete_week, {_TRADING.format('period_first', 'period_last')} AS trading_days,
      (SELECT COUNT(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN period_first AND period_last) AS n_orders
    FROM laid""",
)
def x02(r: Roles) -> DataFrame:
    """Every period with its week number, its trading days, and the orders of its days."""
    window = DateWindow.of_days(STAGES[0][1], STAGES[-1][2])
    orders = scan_window(r.table("orders"), "o_orderdate", window).groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    keys = ["stage", "stage_week", "week_no", "period_first", "period_last", "is_complete_week", "trading_days"]
    return calendar(r).join(orders, "day", "left").groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"))


def rate_entries(r: Roles) -> DataFrame:
    """Rates as they were set: by day of shipping, sku and region of the supplier."""
    lines = r.table("lineitem").select(F.to_date("l_shipdate").alias("dt"), "l_partkey", "l_suppkey", "l_tax", "l_returnflag")
    parts = r.table("part").select("p_partkey", F.col("p_type").alias("sku_id")).where(F.col("sku_id").isin(SKUS))
    suppliers = r.supplier.select("s_suppkey", F.col("grid_id").alias("region_id"))
    rows = scan_window(lines, "dt", TRIAL_DAYS).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("sku_id", "region_id", "dt").agg(
        F.max(rate("l_tax")).alias("configured_rate"),
        F.when(F.max("l_returnflag") == "A", "outside").otherwise("inside").alias("participate_type"),
    )


def price_cards(r: Roles) -> DataFrame:
    """Prices of the region outside the trial, by day of the order."""
    outside = trial_facts(r).where("region_id = 24")
    rows = scan_window(outside, "dt", TRIAL_DAYS)
    price = F.col("list_price")
    return rows.select(
        "dt", "sku_id", price.alias("platform_price"),
        (price - F.col("ordered_num")).alias("supply_price"),
        flag(F.col("ordered_num") > F.col("delivered_num")).alias("is_up_today"),
    )


_AUDIT = f"""design AS ({_DESIGN}), targets AS {_rows(_RATE_ROWS, 'stage, trial_group, region_type, target_rate')},
    stages AS {_rows([s[:3] for s in STAGES], 'stage, first, last')},
    entries AS (SELECT p_type AS sku_id, CAST(s_nationkey AS BIGINT) AS region_id, CAST(l_shipdate AS DATE) AS as_of,
      MAX(CAST(l_tax AS DECIMAL(4,2))) AS configured_rate,
      CASE WHEN MAX(l_returnflag) = 'A' THEN 'outside' ELSE 'inside' END AS participate_type
      FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
      WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{TRIAL_DAYS.first}' AND DATE '{UNTIL}' GROUP BY 1, 2, 3),
    active AS (SELECT DISTINCT dt, sku_id, region_id FROM ({_ITEMS}) WHERE is_valid = 1 AND sku_id IN ({_SKU_LIST})
      AND dt BETWEEN DATE '{TRIAL_DAYS.first}' AND DATE '{UNTIL}'),
    found AS (SELECT a.dt, a.sku_id, a.region_id, e.as_of, CAST(e.configured_rate AS DOUBLE) AS configured_rate, e.participate_type
      FROM active a ASOF LEFT JOIN entries e ON a.sku_id = e.sku_id AND a.region_id = e.region_id AND a.dt >= e.as_of),
    audited AS (SELECT f.*, city_unit, region_type, trial_group, stage, target_rate, ROUND(configured_rate - target_rate, 6) AS deviation
      FROM found f JOIN design USING (region_id) JOIN stages ON dt BETWEEN first AND last
      LEFT JOIN targets USING (stage, trial_group, region_type)),
    alerted AS (SELECT *, concat_ws(',', CASE WHEN abs(deviation) > {RULES.max_deviation} THEN 'RATE_DEVIATION' END,
      CASE WHEN participate_type = 'outside' THEN 'OUTSIDE_TRIAL' END,
      CASE WHEN region_type = 'agent' AND abs(configured_rate - {RULES.self_rate}) <= {RULES.self_rate_margin} THEN 'AGENT_AT_SELF_RATE' END,
      CASE WHEN as_of IS NULL THEN 'NOT_CONFIGURED' END) AS alerts FROM audited),
    cards AS (SELECT dt, sku_id, CAST(MAX(list_price) AS DOUBLE) AS platform_price, CAST(MIN(list_price - ordered_num) AS DOUBLE) AS supply_price,
      MAX(CASE WHEN ordered_num > delivered_num THEN 1 ELSE 0 END) AS is_new_listing FROM ({_ITEMS})
      WHERE region_id = 24 AND sku_id IN ({_SKU_LIST}) AND dt BETWEEN DATE '{TRIAL_DAYS.first}' AND DATE '{UNTIL}' GROUP BY dt, sku_id),
    swings AS (SELECT *, ROUND(supply_price / NULLIF(LAG(supply_price) OVER (PARTITION BY sku_id ORDER BY dt), 0) - 1, 6) AS swing FROM cards)"""


@query(
    "x03",
    f"""WITH {_AUDIT} SELECT 'rate' AS kind, dt, sku_id, region_id, city_unit, region_type, trial_group, stage, as_of, configured_rate, target_rate,
      deviation, participate_type, alerts, CASE WHEN alerts <> '' THEN 'RED' ELSE 'OK' END AS status,
      CAST(NULL AS DOUBLE) AS platform_price, CAST(NULL AS DOUBLE) AS supply_price, CAST(NULL AS DOUBLE) AS implied_rate,
      CAST(NULL AS DOUBLE) AS swing, CAST(NULL AS INTEGER) AS is_new_listing FROM alerted
    UNION ALL SELECT 'price', dt, sku_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
      CASE WHEN abs(swing) > {RULES.max_swing} THEN 'YELLOW' ELSE 'OK' END, platform_price, supply_price,
      ROUND((platform_price - supply_price) / NULLIF(platform_price, 0), 6), swing, is_new_listing FROM swings""",
)
def x03(r: Roles) -> DataFrame:
    """The rate audit and the price trend outside the trial, one below the other."""
    active = scan_window(trial_facts(r), "dt", TRIAL_DAYS).where((F.col("is_valid") == 1) & F.col("sku_id").isin(SKUS))
    audit = trial.rate_audit(active.select("dt", "sku_id", "region_id"), rate_entries(r), calendar(r), design(r), rates(r), RULES)
    swings = trial.price_swings(price_cards(r), SKUS, RULES)
    return audit.withColumn("kind", F.lit("rate")).unionByName(swings.withColumn("kind", F.lit("price")), allowMissingColumns=True)


_ALERT_BOUNDS = RULES.falls["effect"]


@query(
    "x04",
    f"""WITH {_WIDE}, sku_weeks AS (SELECT * FROM wide WHERE level = 'sku' AND stage = 'effect'),
    based AS (SELECT w.*, b.period_first AS base_first, b.order_count AS base_orders, b.active_store_count AS base_stores
      FROM sku_weeks w ASOF LEFT JOIN (SELECT * FROM sku_weeks WHERE is_complete_week) b
      ON w.city_unit = b.city_unit AND w.sku_id = b.sku_id AND w.period_first > b.period_first),
    changed AS (SELECT *, CASE WHEN is_complete_week THEN ROUND(order_count / base_orders - 1, 6) END AS order_count_wow,
      CASE WHEN is_complete_week THEN ROUND(active_store_count / base_stores - 1, 6) END AS active_store_count_wow FROM based)
    SELECT stage, stage_week, period_first, city_unit, trial_group, sku_id, is_complete_week, trading_days, order_count,
      active_store_count, stockout_num, base_first, order_count_wow, active_store_count_wow,
      CASE WHEN NOT is_complete_week THEN 'GRAY' WHEN base_first IS NULL THEN 'NONE'
        WHEN order_count_wow < {_ALERT_BOUNDS['order_count'][1]} OR active_store_count_wow < {_ALERT_BOUNDS['active_store_count'][1]} THEN 'RED'
        WHEN order_count_wow < {_ALERT_BOUNDS['order_count'][0]} OR active_store_count_wow < {_ALERT_BOUNDS['active_store_count'][0]} THEN 'YELLOW'
        ELSE 'GREEN' END AS alert FROM changed""",
)
def x04(r: Roles) -> DataFrame:
    return trial.week_alerts(wide(r), RULES)


_BLOCKS = FALLBACK.n_days // 7
_WEEK_ROWS = [("history", i + 1, d) for i, d in enumerate(HISTORY)]
_WEEK_ROWS += [("fallback", i + 1, FALLBACK.first + timedelta(days=7 * i)) for i in range(_BLOCKS)]
_POWER = f"""design AS ({_DESIGN}), weeks AS {_rows(_WEEK_ROWS, 'basis, week, first')},
    sold AS (SELECT f.*, city_unit FROM ({_ITEMS}) f JOIN design USING (region_id) WHERE is_valid = 1 AND sku_id IN ({_SKU_LIST})),
    weekly AS (SELECT basis, week, sku_id, city_unit, SUM(delivered_amt) AS gmv FROM sold JOIN weeks ON dt BETWEEN first AND first + 6 GROUP BY ALL),
    cells AS (SELECT basis, week, sku_id, city_unit, COALESCE(CAST(gmv AS DOUBLE), 0) AS gmv
      FROM (SELECT * FROM (SELECT DISTINCT city_unit FROM design), (SELECT unnest([{_SKU_LIST}]) AS sku_id), weeks)
      LEFT JOIN weekly USING (basis, week, sku_id, city_unit)),
    chosen AS (SELECT sku_id, COUNT(DISTINCT week) FILTER (WHERE gmv > 0) AS history_weeks,
      CASE WHEN COUNT(DISTINCT week) FILTER (WHERE gmv > 0) >= {RULES.least_weeks} THEN 'history' ELSE 'fallback' END AS basis
      FROM cells WHERE basis = 'history' GROUP BY sku_id),
    city AS (SELECT sku_id, basis, history_weeks, city_unit, COUNT(*) AS n_weeks, AVG(gmv) AS mean, STDDEV_SAMP(gmv) AS dev,
      MAX(gmv) FILTER (WHERE week = 1) AS w1, MAX(gmv) FILTER (WHERE week = 2) AS w2,
      MAX(gmv) FILTER (WHERE week = CASE basis WHEN 'history' THEN {len(HISTORY)} ELSE {_BLOCKS} END - 1) AS w3,
      MAX(gmv) FILTER (WHERE week = CASE basis WHEN 'history' THEN {len(HISTORY)} ELSE {_BLOCKS} END) AS w4
      FROM cells JOIN chosen USING (sku_id, basis) GROUP BY ALL),
    power AS (SELECT sku_id, basis, history_weeks, COUNT(*) AS n_cities, MAX(n_weeks) AS n_weeks,
      AVG(CASE WHEN mean > 0 THEN dev / mean END) AS s,
      CASE WHEN STDDEV_POP(w1) > 0 AND STDDEV_POP(w2) > 0 THEN CORR(w1, w2) END AS a,
      CASE WHEN STDDEV_POP(w3) > 0 AND STDDEV_POP(w4) > 0 THEN CORR(w3, w4) END AS b FROM city GROUP BY ALL),
    needed AS (SELECT *, 4 * (s * {RULES.cv_factor}) * (s * {RULES.cv_factor}) * (1 - least(a, b)) * {RULES.z_square} / {RULES.effect_square} AS n FROM power),
    pairs AS (SELECT x.sku_id, y.sku_id AS other, CASE WHEN STDDEV_POP(x.gmv) > 0 AND STDDEV_POP(y.gmv) > 0 THEN CORR(x.gmv, y.gmv) END AS rho
      FROM cells x JOIN cells y ON x.city_unit = y.city_unit AND x.week = y.week AND x.basis = y.basis AND x.sku_id <> y.sku_id
      WHERE x.basis = 'history' GROUP BY ALL)"""


@query(
    "x05",
    f"""WITH {_POWER} SELECT sku_id, basis, history_weeks, n_cities, n_weeks, ROUND(s, 6) AS sigma_raw, ROUND(s * {RULES.cv_factor}, 6) AS sigma_adjusted,
      ROUND(a, 6) AS rho_pre, ROUND(b, 6) AS rho_post, ROUND(least(a, b), 6) AS rho_main, ROUND(n, 4) AS n_required,
      {RULES.cities_per_group} AS n_actual,
      CASE WHEN n IS NULL THEN 'undefined' WHEN n <= {RULES.cities_per_group} THEN 'sufficient' ELSE 'insufficient' END AS verdict,
      COALESCE((SELECT string_agg(other, ',' ORDER BY other) FROM pairs p WHERE p.sku_id = needed.sku_id
        AND ROUND(rho, 6) > {RULES.max_pair_correlation}), '') AS correlated_skus
    FROM needed""",
)
def x05(r: Roles) -> DataFrame:
    return trial.power_inputs(trial_facts(r), design(r), SKUS, HISTORY, FALLBACK, RULES)
