"""Wide reports deal lines to their orders once, whatever number of roles they join from them."""

from __future__ import annotations

import datetime as dt
import os
import re
import sys

import duckdb
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare  # noqa: E402

from pyspark.sql import functions as F

from stallworks.catalog.registry import REGISTRY
from stallworks.catalog.reports import RULES
from stallworks.operators.reshape import whole_rows
from stallworks.plans.reports import fusion
from stallworks.session import apply_recommended

DAY = dt.datetime(1996, 5, 4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Twelve orders of four stores, one of them unknown, and lines of these and of an unknown order."""
    path = tmp_path_factory.mktemp("one_pass")
    day = lambda n: DAY + dt.timedelta(days=n % 3)
    line = lambda o, n: (
        o, (o + n) % 2 + 1, n % 3 + 1, n, 5.0 + n, 10.0 * o + n, 0.1, 0.02 * n, "RAN"[(o + n) % 3], "OF"[(o * n) % 2], day(o + n)
    )
    rows = {
        "region": ("r_regionkey int, r_name string", [(1, "ASIA"), (2, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "NATION_1", 1), (2, "NATION_2", 2), (7, "NATION_7", 2)]),
        "customer": (
            "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double",
            [(1, 1, "MACHINERY", 1.0), (2, 2, "HOUSEHOLD", 1.0), (3, 7, "BUILDING", -1.0), (5, 7, "FURNITURE", 1.0)],
        ),
        "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", [(1, 1, -1.0), (2, 7, 5.0), (3, 2, -2.0)]),
        "part": (
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            [(1, "hot bolt", "Brand#3", "ECONOMY", 1, 1.0), (2, "cold nut", "Brand#9", "SMALL", 2, 2.0)],
        ),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double",
            [(o, o % 4 + 1, "FOP"[o % 3], day(o), ("2-HIGH", "5-LOW")[o % 2], 1.0) for o in range(1, 13)],
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
            [line(o, n) for o in range(1, 14) for n in range(1, 5)],
        ),
        "events": (
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
            [(e, DAY + dt.timedelta(days=8400 + e % 3), e % 6, ("view", "click", "signup", "purchase", "error")[e % 5], 10.0 * e, f'{{"k": {e % 3}}}')
             for e in range(1, 31)],
        ),
    }
    for name, (schema, values) in rows.items():
        pq.write_table(spark.createDataFrame(values, schema).toArrow(), f"{path}/{name}.parquet")
    return str(path)


def run(spark, name: str, folder: str) -> str:
    """The plan that was run in the end, without what it started from; no side is small enough to be sent to all."""
    apply_recommended(spark)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = REGISTRY[name].run(spark, folder)
        assert found.collect()
        return found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)


def dealt(plan: str, column: str) -> int:
    """How often rows are shuffled by a column first."""
    return len([x for x in plan.splitlines() if re.search(rf"\bExchange hashpartitioning\({column}#", x) and "ReusedExchange" not in x])


def scans(plan: str, table: str) -> int:
    """How often a table is read."""
    return len([x for x in plan.splitlines() if "FileScan parquet" in x and f"/{table}.parquet" in x])


def test_branches_that_read_other_columns_share_one_exchange(spark):
    apply_recommended(spark)
    rows = whole_rows(spark.createDataFrame([(1, 2, 3), (1, None, 5), (None, 7, 8)], "k long, a long, b long").repartition("k"), "k")
    both = rows.groupBy("k").sum("a").join(rows.groupBy("k").max("b"), "k", "full")
    assert sorted(map(tuple, both.where("k IS NOT NULL").collect())) == [(1, 2, 5)]
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, 2, 3), (1, None, 5), (None, 7, 8)]
    plan = both._jdf.queryExecution()
    both.collect()
    assert dealt(plan.executedPlan().toString().split("== Initial Plan ==")[0], "k") == 1


@pytest.mark.parametrize("name", ["q01", "q06", "q07", "q11", "q16"])
def test_rows_equal_the_sql(spark, folder, name):
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    ok, text = compare(spark, con, REGISTRY[name], folder)
    assert ok, text


def test_everything_of_a_ticket_is_put_together_by_order(spark, folder):
    plan = run(spark, "q07", folder)
    assert scans(plan, "lineitem") == 2  # by order for all of it, by sku for the goods cards
    assert dealt(plan, "ticket_id") == dealt(plan, "order_item_id") == dealt(plan, "item_order_no") == 0


@pytest.mark.parametrize("name", ["q01", "q06", "q11"])
def test_lines_meet_orders_and_goods_once(spark, folder, name):
    plan = run(spark, name, folder)
    assert scans(plan, "lineitem") == scans(plan, "orders") == 1
    if name != "q01":  # its facts are looked up and added up by store and day
        assert dealt(plan, "dt") <= 2  # grids of a store's day and agent-run grids


def test_items_of_the_fused_report_are_not_kept(spark, folder):
    plan = run(spark, "q16", folder)
    assert "InMemoryTableScan" not in plan
    assert scans(plan, "lineitem") <= 3  # with goods and orders once, and for the two lookups of suppliers
    # rows of all malls are dealt by category once; of the home mall's, two roles read some
    assert len([x for x in plan.splitlines() if "REPARTITION_BY_COL" in x and "cat1#" in x and "ReusedExchange" not in x]) <= 3


def test_marks_of_stores_meet_numbers_that_read_the_same(spark):
    detail = [(DAY.date(), 12, "Brand#3", "direct", None, None, "ECONOMY", "1.5", 1, "2", 1, 1, 1), (DAY.date(), 7, "Brand#3", "agent", None, None, "SMALL", "1", 1, "1", 1, 1, 1)]
    schema = ("dt date, store_id long, cat4 string, operate_type string, trial_group string, special_label string, cat1 string, "
              "delivered_amt string, ordered_num int, commission_amt string, is_pilot int, is_after_sale int, is_rebuy int")
    flags = spark.createDataFrame([(DAY.date(), t, 1) for t in (" 12", "07", "7.0", "x", None)], "dt date, store_id string, buys int")
    found = {}
    for kind in ("bigint", "string"):
        rows = spark.createDataFrame(detail, schema).withColumn("store_id", F.col("store_id").cast(kind))
        found[kind] = fusion.pilot_kpis(rows, flags, {"buys": "Brand#3"}, RULES).first().asDict()
    assert found["bigint"] == found["string"] and found["bigint"]["pilot_stores"] == 1
    assert found["bigint"]["pilot_mark_rebuy_stores"] == 1
