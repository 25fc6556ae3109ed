"""Sinks: SNK01–SNK10. Each writes under the shared folder and returns what it reads back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.predicates import Condition, day_window
from ..params import DateWindow
from ..session import scratch_path
from ..sinks import merge, output, reconcile, replace
from ..sinks.partitions import overwrite_days
from .registry import query
from .roles import Roles, money


def daily_events(r: Roles) -> DataFrame:
    """Events per day and type: the table the write queries work on."""
    return r.table("events").groupBy(F.to_date("ts").alias("dt"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("value")).cast("double").alias("amount")
    )


DAILY_SQL = """daily AS (SELECT CAST(ts AS DATE) AS dt, event_type, COUNT(*) AS n,
    CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS amount FROM events GROUP BY 1, 2)"""
WINDOW = DateWindow(date(2024, 1, 15), -7, 0, buffer=2)
CLEANUP = WINDOW.cleanup()


#: Each type's total as a row without a day, beside the dated ones.
UNDATED_SQL = """undated AS (SELECT CAST(NULL AS DATE) AS dt, event_type, SUM(n)::BIGINT AS n,
    CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM daily GROUP BY event_type),
    stored AS (SELECT * FROM daily UNION ALL SELECT * FROM undated)"""


def undated_events(r: Roles) -> DataFrame:
    rows = r.table("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("value")).cast("double").alias("amount")
    )
    return rows.select(F.lit(None).cast("date").alias("dt"), "event_type", "n", "amount")


def written_table(r: Roles, label: str, undated: bool = False) -> str:
    path = scratch_path(r.spark, label)
    rows = daily_events(r)
    overwrite_days(rows.unionByName(undated_events(r)) if undated else rows, path, "dt")
    return path


def read_back(r: Roles, path: str) -> DataFrame:
    """The target with its schema given: a table whose days are all gone is still a table."""
    schema = "event_type string, n bigint, amount double, dt date"
    return r.spark.read.schema(schema).parquet(path).select("dt", "event_type", "n", "amount")


def purchases_again(r: Roles) -> DataFrame:
    """New content of the window: purchases only, doubled, and none on two of its days."""
    days = F.col("dt").between(WINDOW.first, WINDOW.last) & ~F.col("dt").isin(date(2024, 1, 9), date(2024, 1, 12))
    rows = daily_events(r).where(days & (F.col("event_type") == "purchase"))
    return rows.withColumns({"n": F.col("n") * 2, "amount": F.col("amount") * 2})


NEW_SQL = f"""fresh AS (SELECT dt, event_type, n * 2 AS n, amount * 2 AS amount FROM daily WHERE event_type = 'purchase'
    AND dt BETWEEN DATE '{WINDOW.first}' AND DATE '{WINDOW.last}' AND dt NOT IN (DATE '2024-01-09', DATE '2024-01-12'))"""


def _replaced_sql(first: date, last: date) -> str:
    return f"""WITH {DAILY_SQL}, {NEW_SQL} SELECT * FROM daily WHERE NOT dt BETWEEN DATE '{first}' AND DATE '{last}'
    UNION ALL SELECT * FROM fresh"""


@query("snk01", _replaced_sql(WINDOW.first, WINDOW.last))
def snk01(r: Roles) -> DataFrame:
    """Replace a window twice; the second run changes nothing."""
    path = written_table(r, "snk01")
    for _ in range(2):
        replace.replace_window(purchases_again(r), path, "dt", WINDOW)
    return read_back(r, path)


@query("snk02", _replaced_sql(CLEANUP.first, CLEANUP.last))
def snk02(r: Roles) -> DataFrame:
    """The cleared window reaches two buffer days further back."""
    path = written_table(r, "snk02")
    replace.replace_window(purchases_again(r), path, "dt", WINDOW.cleanup())
    return read_back(r, path)


@query(
    "snk03",
    f"""WITH {DAILY_SQL}, {NEW_SQL} SELECT * FROM daily
    WHERE NOT dt BETWEEN (SELECT MIN(dt) FROM fresh) AND (SELECT MAX(dt) FROM fresh) UNION ALL SELECT * FROM fresh""",
)
def snk03(r: Roles) -> DataFrame:
    """The window is what the result covers; an empty result clears nothing."""
    path = written_table(r, "snk03")
    replace.replace_own_window(purchases_again(r), path, "dt")
    replace.replace_own_window(purchases_again(r).where(F.lit(False)), path, "dt")
    return read_back(r, path)


@query(
    "snk04",
    f"""WITH {DAILY_SQL} SELECT 'purchase' AS route, dt, event_type, n, amount FROM daily
      WHERE NOT (dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' AND event_type <> 'purchase')
    UNION ALL SELECT 'signup', dt, event_type, n, amount FROM daily
      WHERE NOT (dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-04' AND event_type <> 'signup')""",
)
def snk04(r: Roles) -> DataFrame:
    """Two targets, each with its own window."""
    windows = {"purchase": DateWindow(date(2024, 1, 15), -5, 0), "signup": DateWindow(date(2024, 1, 4), -3, 0)}
    result = None
    for route, window in windows.items():
        path = written_table(r, f"snk04-{route}")
        rows = daily_events(r).where((F.col("event_type") == route) & F.col("dt").between(window.first, window.last))
        replace.replace_window(rows, path, "dt", window)
        out = read_back(r, path).select(F.lit(route).alias("route"), "*")
        result = out if result is None else result.unionByName(out)
    return result


@query(
    "snk05",
    f"""WITH {DAILY_SQL}, {UNDATED_SQL} SELECT * FROM stored WHERE NOT coalesce(dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'
      AND contains(event_type, 'i'), false) AND NOT (n < 60 OR event_type = 'error')""",
)
def snk05(r: Roles) -> DataFrame:
    """Two deletes: conditions joined by and, then by or. Rows without a day are deleted too."""
    path = written_table(r, "snk05", undated=True)
    window = day_window("dt", date(2024, 1, 5), date(2024, 1, 8))
    merge.delete_from(r.spark, path, "dt", [*window, Condition("event_type", "contains", "i")])
    merge.delete_from(
        r.spark, path, "dt", [Condition("n", "isLess", 60), Condition("event_type", "is", "error")], "or"
    )
    return read_back(r, path)


@query(
    "snk06",
    f"""WITH {DAILY_SQL}, {UNDATED_SQL}, {NEW_SQL}, extra AS (SELECT dt + 100 AS dt, event_type, n, amount FROM fresh),
    lone AS (SELECT dt, event_type, -n AS n, amount FROM undated WHERE event_type = 'purchase'),
    dated AS (SELECT d.* FROM daily d LEFT JOIN fresh f ON f.dt = d.dt AND f.event_type = d.event_type WHERE f.dt IS NULL
      UNION ALL SELECT * FROM fresh UNION ALL SELECT * FROM extra)
    SELECT 'merge' AS mode, * FROM (SELECT * FROM dated UNION ALL SELECT * FROM undated
      UNION ALL SELECT * FROM lone)
    UNION ALL SELECT 'ignore', * FROM (SELECT * FROM stored UNION ALL SELECT * FROM extra UNION ALL SELECT * FROM lone)
    UNION ALL SELECT 'counts', * FROM (SELECT d.dt, d.event_type, coalesce(f.n, d.n), d.amount FROM daily d LEFT JOIN fresh f
      ON f.dt = d.dt AND f.event_type = d.event_type UNION ALL SELECT dt, event_type, n, NULL FROM extra
      UNION ALL SELECT * FROM undated UNION ALL SELECT dt, event_type, n, NULL FROM lone)""",
)
def snk06(r: Roles) -> DataFrame:
    """Upsert on (day, type): replace duplicates, leave them, or replace their counts alone.

    A row without a day is added beside those that are there.
    """
    fresh = purchases_again(r)
    lone = undated_events(r).where("event_type = 'purchase'").withColumn("n", -F.col("n"))
    new = fresh.unionByName(fresh.withColumn("dt", F.date_add("dt", 100))).unionByName(lone)
    result = None
    for mode, columns in (("merge", None), ("ignore", None), ("counts", ["n"])):
        path = written_table(r, f"snk06-{mode}", undated=True)
        merge.upsert_into(new, path, "dt", ["dt", "event_type"], "merge" if columns else mode, columns)
        out = read_back(r, path).select(F.lit(mode).alias("mode"), "*")
        result = out if result is None else result.unionByName(out)
    return result


@query("snk07", "SELECT p_partkey, 'say \"' || p_name || '\", ok' AS label, p_retailprice FROM part")
def snk07(r: Roles) -> DataFrame:
    """Delimited result, quotes and separators inside values."""
    path = scratch_path(r.spark, "snk07")
    label = F.concat(F.lit('say "'), "p_name", F.lit('", ok'))
    output.write_delimited(r.table("part").select("p_partkey", label.alias("label"), "p_retailprice"), path)
    schema = "p_partkey bigint, label string, p_retailprice double"
    return r.spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query(
    "snk08",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
    CASE WHEN l_returnflag = 'R' THEN l_discount END AS disc FROM lineitem""",
)
def snk08(r: Roles) -> DataFrame:
    """Decimals become doubles, NaN and infinity become null."""
    odd = F.when(F.col("l_returnflag") == "R", F.col("l_discount")).when(
        F.col("l_returnflag") == "A", F.lit(float("nan"))
    ).otherwise(F.lit(float("-inf")))
    rows = r.table("lineitem").select(
        "l_orderkey", "l_linenumber", money("l_extendedprice").alias("price"), odd.alias("disc")
    )
    path = scratch_path(r.spark, "snk08")
    output.normalise_for_sink(rows).write.parquet(path)
    return r.spark.read.parquet(path)


@query(
    "snk09",
    f"""WITH {DAILY_SQL} SELECT *, CAST(NULL AS VARCHAR) AS remark FROM daily WHERE dt <= DATE '2024-01-20'
    UNION ALL SELECT dt, event_type, n, CAST(NULL AS DOUBLE), 'late' FROM daily WHERE dt > DATE '2024-01-20'""",
)
def snk09(r: Roles) -> DataFrame:
    """A stored table gets a column that it lacks; a column the new rows lack stays null."""
    cut = F.lit("2024-01-20").cast("date")
    daily = daily_events(r)
    path = scratch_path(r.spark, "snk09")
    overwrite_days(daily.where(F.col("dt") <= cut), path, "dt")
    new = daily.where(F.col("dt") > cut).drop("amount").withColumn("remark", F.lit("late"))
    merge.append_into(new, path, "dt")
    return merge.read_evolved(r.spark, path).select("dt", "event_type", "n", "amount", "remark")


@query(
    "snk10",
    f"""WITH {DAILY_SQL}, {NEW_SQL} SELECT 'all' AS route, COUNT(*) AS source_rows, COUNT(*) AS written_rows, 0::BIGINT AS delta FROM daily
    UNION ALL SELECT 'window', (SELECT COUNT(*) FROM daily WHERE dt BETWEEN DATE '{WINDOW.first}' AND DATE '{WINDOW.last}'), COUNT(*),
      (SELECT COUNT(*) FROM daily WHERE dt BETWEEN DATE '{WINDOW.first}' AND DATE '{WINDOW.last}') - COUNT(*) FROM fresh
    UNION ALL SELECT 'total', (SELECT COUNT(*) FROM daily) + (SELECT COUNT(*) FROM daily WHERE dt BETWEEN DATE '{WINDOW.first}' AND DATE '{WINDOW.last}'),
      (SELECT COUNT(*) FROM daily) + COUNT(*), (SELECT COUNT(*) FROM daily WHERE dt BETWEEN DATE '{WINDOW.first}' AND DATE '{WINDOW.last}') - COUNT(*) FROM fresh""",
)
def snk10(r: Roles) -> DataFrame:
    """Rows offered against rows found in the target, per route and in total."""
    whole = written_table(r, "snk10-all")
    part = written_table(r, "snk10-window")
    replace.replace_window(purchases_again(r), part, "dt", WINDOW)
    inside = F.col("dt").between(WINDOW.first, WINDOW.last)
    return reconcile.reconcile(
        {
            "all": (daily_events(r), read_back(r, whole)),
            "window": (daily_events(r).where(inside), read_back(r, part).where(inside)),
        }
    )
