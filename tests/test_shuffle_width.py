"""What the wide reports shuffle: tasks are cut by size, names and repeats stay out of exchanges."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from stallworks.catalog.registry import REGISTRY
from stallworks.catalog.roles import Roles
from stallworks.session import RECOMMENDED, apply_recommended

DAY = dt.datetime(1996, 5, 4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two orders of one store and day, served by three suppliers of two grids; nations and lines come twice."""
    path = tmp_path_factory.mktemp("width")
    rows = {
        "region": ("r_regionkey long, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(3, "NATION_3", 0), (7, "NATION_7", 1)] * 2),
        "customer": ("c_custkey long, c_nationkey long, c_mktsegment string", [(1, 3, "MACHINERY")]),
        "supplier": ("s_suppkey long, s_nationkey long, s_acctbal double", [(1, 3, -1.0), (2, 7, 5.0), (3, 7, -2.0), (4, None, 1.0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string", [(1, "hot bolt", "Brand#3", "SMALL")]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
            [(1, 1, "F", DAY, "2-HIGH"), (2, 1, "F", DAY, "5-LOW")],
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
            [(o, 1, s, s, 5.0, 10.0, 0.1, 0.02, "R", "F", DAY) for o, s in ((1, 1), (1, 2), (2, 2), (2, 3), (2, 4))] * 2,
        ),
        "events": ("event_id long, ts timestamp, user_id long, event_type string, value double, props string", []),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def exchanges(df) -> list[str]:
    """Output columns and keys of each shuffle, as the formatted plan prints them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"\bExchange hashpartitioning", line)]


def test_tasks_are_cut_by_size(spark):
    apply_recommended(spark)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        assert spark.conf.get(key) == RECOMMENDED[key] == "16m"
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 400


def test_places_of_a_store_are_collected_in_one_shuffle(spark, folder):
    found = Roles(apply_recommended(spark), folder).store_dim
    assert sorted((r.store_id, r.mall_id, r.grid_id, r.bd_id) for r in found.collect()) == [(1, 0, 3, None), (1, 1, 7, 107)]
    by_store = found.groupBy("dt", "store_id").agg(F.max("county_name"))
    assert not [e for e in exchanges(by_store) if "county_name" in e or "bd_name" in e]
    assert len([e for e in exchanges(by_store) if "store_id" in e and "dt" in e]) == 1


def test_suppliers_are_looked_up_before_lines_are_shuffled(spark, folder):
    found = Roles(apply_recommended(spark), folder).agent_grid
    active = found.where("status = 1").select("dt", "mall_id", "grid_id").distinct()
    assert sorted((r.mall_id, r.grid_id) for r in active.collect()) == [(0, 3), (1, 7)]
    assert not [e for e in exchanges(found) if "l_suppkey" in e]


@pytest.mark.parametrize("name", ["q07", "q08"])
def test_printed_names_are_added_after_the_last_join(spark, folder, name):
    found = REGISTRY[name].run(spark, folder)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    last_join = next(i for i, line in enumerate(plan.splitlines()) if re.search(r"\bJoin ", line))
    below = "\n".join(plan.splitlines()[last_join:])
    assert not re.findall(r"\b(?:order_item_no|ticket_no|refund_no|sku_code|handler_name|service_remark)#", below.replace("item_order_no#", ""))
    assert found.count() > 0
