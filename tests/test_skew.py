"""Reports over data in which one store and one sku hold a third of the rows."""

import os

import duckdb
import pytest

from stallworks.catalog import REGISTRY
from tools.compare import TABLES, compare, connect

SF_DIR = "/root/testdata/sf0.001"
HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM '{}'",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 1 THEN 1 ELSE l_partkey END AS l_partkey) FROM '{}'",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for t in TABLES:
        source = f"{SF_DIR}/{t}.parquet"
        if t in HOT:
            con.execute(f"COPY ({HOT[t].format(source)}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        else:
            os.symlink(source, f"{folder}/{t}.parquet")
    share = "SELECT max(n) * 3.1 >= sum(n) FROM (SELECT count(*) AS n FROM '{}/{}.parquet' GROUP BY {})"
    assert con.execute(share.format(folder, "orders", "o_custkey")).fetchone()[0]
    assert con.execute(share.format(folder, "lineitem", "l_partkey")).fetchone()[0]
    return folder


@pytest.mark.parametrize("name", ["q06", "q07", "q08", "q11", "jon03"])
def test_hot_store_and_sku(spark, skewed, name):
    ok, text = compare(spark, connect(skewed), REGISTRY[name], skewed)
    assert ok, text
