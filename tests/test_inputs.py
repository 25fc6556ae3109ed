"""Text days, skipped and unreadable lines, mapped routes, logged steps, grids with maps."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stallworks.functions.coerce import FieldType
from stallworks.functions.dates import covers, serial_to_day
from stallworks.operators.joins import grid_product, hot_key_join
from stallworks.plans import routing
from stallworks.plans.routing import Route
from stallworks.sources import delimited


def test_ranges_over_text_days(spark):
    rows = [("2026/06/01", "2026-06-30"), ("soon", "2026-06-30"), (None, "2026-06-30"), ("2026-06-01", "2026/05/01")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(F.coalesce(covers("a", "b", date(2026, 6, 15)), F.lit(False))).collect()]
    assert got == [True, False, False, False]


def test_serials_up_to_the_last_day(spark):
    df = spark.createDataFrame([(1.5,), (150000.0,), (2958465.9,), (2958466.0,), (-1.0,)], "n double")
    got = [r[0] for r in df.select(serial_to_day("n")).collect()]
    assert got == [date(1899, 12, 31), date(1899, 12, 30) + timedelta(150000), date(9999, 12, 31), None, None]


def test_rows_above_the_header_and_unreadable_cells(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"f{k}.csv").write_text(f"note {k}\nsecond,note\na,b\n1,x\nbad,\"y,z\"\n3,note {k}\n")
    df = delimited.read_delimited(spark, str(tmp_path), "a int, b string", separator=",", skip_rows=2, unreadable="line")
    got = sorted((r["a"] or 0, r["b"], r["line"]) for r in df.collect())
    assert got == [(0, "y,z", 'bad,"y,z"')] * 2 + [(1, "x", None)] * 2 + [(3, "note 0", None), (3, "note 1", None)]
    assert tuple(delimited.count_unreadable(df, "line").first()) == (6, 2)
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, str(tmp_path), "a int", separator=",", skip_rows=1, multi_line=True)


def test_mapped_route_writes_target_fields(spark, tmp_path):
    rows = spark.createDataFrame([(date(2026, 6, 1), "a", "3"), (date(2026, 6, 2), "b", "x")], "dt date, kind string, n string")
    mapping = {"dt": ("day", FieldType.DATE), "kind": ("label", FieldType.SINGLE_SELECT), "n": ("count", FieldType.NUMBER)}
    path = str(tmp_path / "out")
    calls = spark.sparkContext.accumulator(0)
    counted = rows.rdd.map(lambda r: (calls.add(1), r)[1]).toDF(rows.schema)
    routes = [Route("one", "pool", lambda df: df.write.parquet(path), mapping=mapping, level="warn")]
    results = routing.run_routes({"pool": counted}, routes)
    got = spark.read.parquet(path)
    assert got.columns == ["day", "label", "count"]
    assert {(r["day"], r["label"]["text"], r["count"]) for r in got.collect()} == {
        (1780272000000, "a", 3.0), (1780358400000, "b", None)
    }
    assert results[0].success and calls.value == 2  # the input was computed once


def test_steps_log_their_shapes(spark):
    steps = [("even", lambda df: df.where("id % 2 = 0")), ("twice", lambda df: df.withColumn("x", F.col("id") * 2))]
    df, shapes = routing.run_steps_logged(spark.range(10), steps)
    assert df.count() == 5
    assert [(s.step, s.columns, s.rows) for s in shapes] == [("even", ("id",), 5), ("twice", ("id", "x"), 5)]


def test_products_and_hot_keys_with_map_columns(spark):
    left = spark.range(3)
    right = spark.range(4).select(F.col("id").alias("r"), F.create_map(F.lit("a"), "id").alias("m"))
    assert grid_product(left, right).count() == 12
    fact = spark.range(50).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
    dim = spark.createDataFrame([(1, "x")], "k int, v string")
    assert hot_key_join(fact, dim, ["k"]).where("v = 'x'").count() == 50
