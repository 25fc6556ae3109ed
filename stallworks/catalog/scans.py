"""Sources: SRC01–SRC11."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.coerce import FieldType
from ..params import DateWindow, SourceOffsets
from ..session import scratch_path
from ..sources import delimited, records, tables
from .registry import query
from .roles import EVENT_FIRST, EVENT_LAST, Roles, money

WINDOW = DateWindow(date(2000, 12, 31), -1826, 0)
LATE_EVENTS = DateWindow(date(2024, 1, 20), -6, 0)


@query(
    "src01",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, o_totalprice FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{WINDOW.first}' AND DATE '{WINDOW.last}'""",
)
def src01(r: Roles) -> DataFrame:
    orders = tables.scan_window(r.table("orders"), "o_orderdate", WINDOW)
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("dt"), "o_totalprice")


@query(
    "src02",
    f"""SELECT user_id, dt, n, n_before FROM (
      SELECT user_id, dt, n, LAG(n) OVER (PARTITION BY user_id ORDER BY dt) AS n_before FROM (
        SELECT user_id, CAST(ts AS DATE) AS dt, COUNT(*) AS n FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '{LATE_EVENTS.first}' - 15 AND DATE '{LATE_EVENTS.last}'
        GROUP BY 1, 2)) WHERE dt BETWEEN DATE '{LATE_EVENTS.first}' AND DATE '{LATE_EVENTS.last}'""",
)
def src02(r: Roles) -> DataFrame:
    """The scan reaches 15 days back so that the first days have a predecessor."""
    from ..operators.ranking import previous_value

    wide = tables.scan_window(r.table("events"), "ts", LATE_EVENTS, lookback=15)
    daily = wide.groupBy("user_id", F.to_date("ts").alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    lagged = daily.withColumn("n_before", previous_value(["user_id"], "dt", "n"))
    return tables.scan_window(lagged, "dt", LATE_EVENTS)


@query(
    "src03",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS dt FROM orders
    WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)""",
)
def src03(r: Roles) -> DataFrame:
    newest = tables.latest_snapshot(r.table("orders"), "o_orderdate")
    return newest.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"))


@query(
    "src04",
    """SELECT order_id, dt FROM order_day WHERE dt = (SELECT MAX(dt) FROM order_day) - 1""",
)
def src04(r: Roles) -> DataFrame:
    return tables.latest_snapshot(r.orders, "dt", minus=1)


RECORD_TYPES = {
    "day": FieldType.DATE,
    "kind": FieldType.SINGLE_SELECT,
    "tags": FieldType.MULTI_SELECT,
    "owner": FieldType.PERSON,
    "amount": FieldType.NUMBER,
    "note": FieldType.TEXT,
    "done": FieldType.CHECKBOX,
    "untyped": None,
}


def event_records(r: Roles) -> DataFrame:
    """Events as configuration records: an id and a JSON object of fields."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    person = F.struct(user.alias("id"), F.concat(F.lit("u"), user).alias("name"))
    text = lambda c: F.struct(c.alias("text"))
    fields = F.struct(
        (F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400000).alias("day"),
        text(kind).alias("kind"),
        F.array(text(kind), text(user)).alias("tags"),
        F.array(person).alias("owner"),
        money("value").cast("string").alias("amount"),
        F.col("props").alias("note"),
        (kind == "purchase").alias("done"),
        text(kind).alias("untyped"),
    )
    return r.table("events").select(
        F.col("event_id").cast("string").alias("record_id"), F.to_json(fields).alias("fields")
    )


@query(
    "src05",
    """SELECT CAST(event_id AS VARCHAR) AS _record_id, CAST(ts AS DATE) AS day, event_type AS kind,
    event_type || '|' || user_id AS tags, CAST(user_id AS VARCHAR) AS owner,
    CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount, props AS note,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS done, event_type AS untyped FROM events""",
)
def src05(r: Roles) -> DataFrame:
    """Records written as JSON lines and read back typed."""
    path = scratch_path(r.spark, "records")
    event_records(r).write.json(path)
    raw = r.spark.read.schema("record_id string, fields string").json(path)
    typed = records.extract_records(raw, RECORD_TYPES)
    return typed.select(
        "_record_id",
        F.to_date("day").alias("day"),
        "kind",
        F.array_join("tags", "|").alias("tags"),
        F.array_join("owner", "|").alias("owner"),
        "amount",
        "note",
        F.col("done").cast("int").alias("done"),
        "untyped",
    )


@query(
    "src06",
    """SELECT 'open' AS bound, event_id, CAST(ts AS DATE) AS dt FROM events
    WHERE ts >= TIMESTAMP '2024-01-12'
    UNION ALL SELECT 'closed', event_id, CAST(ts AS DATE) FROM events
    WHERE ts >= TIMESTAMP '2024-01-14' AND CAST(ts AS DATE) <= DATE '2024-01-21'""",
)
def src06(r: Roles) -> DataFrame:
    """Closed lower bound; the upper bound exists only where the source sets one."""
    events = r.table("events").select("event_id", "ts")
    open_end = tables.scan_from(events, "ts", LATE_EVENTS, SourceOffsets(extra_start=-2))
    closed = tables.scan_from(events, "ts", LATE_EVENTS, SourceOffsets(extra_end=1))
    both = open_end.withColumn("bound", F.lit("open")).unionByName(closed.withColumn("bound", F.lit("closed")))
    return both.select("bound", "event_id", F.to_date("ts").alias("dt"))


@query(
    "src07",
    """SELECT 'base' AS source, event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'
    UNION ALL SELECT 'day_before', event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-19'""",
)
def src07(r: Roles) -> DataFrame:
    events = r.table("events").select("event_id", "ts")
    today = tables.scan_day(events, "ts", LATE_EVENTS.base).withColumn("source", F.lit("base"))
    before = tables.scan_day(events, "ts", LATE_EVENTS.base, lag=1).withColumn("source", F.lit("day_before"))
    return today.unionByName(before).select("source", "event_id")


@query(
    "src08",
    """SELECT c_custkey, c_name, c_acctbal, DATE '1995-01-01' + CAST(c_nationkey AS INTEGER) AS opened FROM customer""",
)
def src08(r: Roles) -> DataFrame:
    """Tab-separated text with quotes inside values, read with a given schema.

    The header is skipped as a row, as where notes stand above it.
    """
    path = scratch_path(r.spark, "delimited")
    source = r.table("customer").select(
        "c_custkey",
        F.concat(F.lit('"'), "c_name", F.lit('"\t')).alias("c_name"),
        "c_acctbal",
        F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), F.col("c_nationkey")), "yyyy/MM/dd").alias("opened"),
        "c_mktsegment",
    )
    source.write.option("header", True).option("sep", "\t").option("escape", '"').csv(path)
    df = delimited.read_delimited(
        r.spark,
        path,
        "c_custkey bigint, c_name string, c_acctbal double, opened string, c_mktsegment string",
        separator="\t",
        header=False,
        skip_rows=1,
        columns=["c_custkey", "c_name", "c_acctbal", "opened"],
        day_columns=["opened"],
    )
    return df.withColumn("c_name", F.regexp_replace("c_name", '["\t]', ""))


@query("src09", "SELECT p_partkey, p_brand FROM part")
def src09(r: Roles) -> DataFrame:
    return tables.project(r.table("part"), ["p_partkey", "p_brand"])


@query(
    "src10",
    "SELECT 'constant' AS source, CAST(d.dummy AS BIGINT) AS n FROM (VALUES (1)) AS d(dummy) UNION ALL SELECT 'orders', COUNT(*) FROM orders",
)
def src10(r: Roles) -> DataFrame:
    """The one-row relation next to a table's row count."""
    constant = tables.one_row(r.spark).select(F.lit("constant").alias("source"), F.col("dummy").cast("bigint").alias("n"))
    counted = r.table("orders").agg(F.count(F.lit(1)).alias("n")).select(F.lit("orders").alias("source"), "n")
    return constant.unionByName(counted)


@query(
    "src11",
    f"""SELECT s.dt, COUNT(event_id) AS n_events
    FROM (SELECT CAST(UNNEST(generate_series({EVENT_FIRST}, {EVENT_LAST}, INTERVAL 1 DAY)) AS DATE) AS dt) s
    LEFT JOIN events ON CAST(ts AS DATE) = s.dt GROUP BY s.dt""",
)
def src11(r: Roles) -> DataFrame:
    """Calendar spine with the events of each day; days without events stay."""
    daily = r.table("events").groupBy(F.to_date("ts").alias("dt")).agg(F.count(F.lit(1)).alias("n_events"))
    spine = tables.day_spine(r.spark, r.event_days)
    return spine.join(daily, "dt", "left").fillna({"n_events": 0})

