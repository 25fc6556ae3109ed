"""Every registered query against its SQL, on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, connect  # noqa: E402

from stallworks.catalog import REGISTRY  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
#: No pairing without a key, no Python in the rows.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "Python")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    query = REGISTRY[name]
    df = query.run(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in UNWANTED if bad in plan], plan
    ok, text = compare(spark, con, query, SF_DIR, df)
    assert ok, text


def test_window_scan_is_pushed_down(spark):
    plan = REGISTRY["src01"].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_reports_read_only_their_columns(spark):
    plan = REGISTRY["q13"].run(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in plan.split("Relation")[0]


def test_every_query_has_sql():
    assert [n for n, q in REGISTRY.items() if not q.sql] == []


def test_inventory_is_complete():
    want = {
        "src": 11, "snk": 10, "prj": 11, "flt": 12, "jon": 15, "agg": 17, "win": 9, "srt": 3,
        "set": 3, "scl": 31, "dq": 11, "rt": 6, "q": 17, "x": 5,
    }
    names = {f"{p}{i:02d}" for p, n in want.items() for i in range(1, n + 1)}
    assert names == set(REGISTRY)
