"""Writes: idempotence, untouched days, refusal, schema growth, routing."""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from stallworks.functions.coerce import FieldType, coerce_frame, coercion_issues
from stallworks.functions.predicates import Condition
from stallworks.operators import quality
from stallworks.operators.events import current_failures, status_summary
from stallworks.params import DateWindow
from stallworks.plans import routing
from stallworks.plans.routing import Route, RoutesFailed
from stallworks.sinks import merge
from stallworks.sinks.partitions import overwrite_days, partition_days
from stallworks.sinks.reconcile import reconcile
from stallworks.sinks.replace import replace_own_window, replace_window, replaced

DAYS = [date(2026, 6, d) for d in range(1, 11)]


@pytest.fixture
def table(spark, path):
    df = spark.createDataFrame([(d, f"k{d.day}", d.day) for d in DAYS], "dt date, k string, v long")
    overwrite_days(df, path, "dt")
    return path


def content(spark, path):
    return Counter((r["dt"], r["k"], r["v"]) for r in spark.read.parquet(path).collect())


def test_replace_window_is_idempotent_and_local(spark, table):
    window = DateWindow(date(2026, 6, 8), -3, 0)
    new = spark.createDataFrame([(date(2026, 6, 6), "new", 60), (date(2026, 6, 6), "new2", 61)], "dt date, k string, v long")
    before = content(spark, table)
    expected = {k: n for k, n in before.items() if not window.first <= k[0] <= window.last}
    expected.update({(date(2026, 6, 6), "new", 60): 1, (date(2026, 6, 6), "new2", 61): 1})
    logical = Counter((r["dt"], r["k"], r["v"]) for r in replaced(spark.read.parquet(table).select("dt", "k", "v"), new, "dt", window).collect())
    for _ in range(2):
        report = replace_window(new, table, "dt", window)
        assert content(spark, table) == Counter(expected) == logical
    assert report["written"] == [date(2026, 6, 6)]
    assert date(2026, 6, 5) not in partition_days(spark, table, "dt")


def test_replace_window_refuses_rows_outside(spark, table):
    before = content(spark, table)
    bad = spark.createDataFrame([(date(2026, 7, 1), "x", 1)], "dt date, k string, v long")
    with pytest.raises(Exception, match="outside the replaced window"):
        replace_window(bad, table, "dt", DateWindow(date(2026, 6, 8), -3, 0))
    assert content(spark, table) == before


def test_own_window_of_nothing_clears_nothing(spark, table):
    before = content(spark, table)
    empty = spark.createDataFrame([], "dt date, k string, v long")
    assert replace_own_window(empty, table, "dt") is None
    assert content(spark, table) == before


def test_upsert_modes_and_partial_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 0)], "k long, s string, v long")
    new = spark.createDataFrame([(2, "B", 20), (3, "C", 30), (None, "N", 9)], "k long, s string, v long")
    rows = lambda df: Counter(tuple(r) for r in df.select("k", "s", "v").collect())
    assert rows(merge.upsert(old, new, ["k"])) == Counter([(1, "a", 1), (2, "B", 20), (3, "C", 30), (None, "n", 0), (None, "N", 9)])
    assert rows(merge.upsert(old, new, ["k"], "ignore")) == Counter(
        [(1, "a", 1), (2, "b", 2), (3, "C", 30), (None, "n", 0), (None, "N", 9)]
    )
    part = merge.upsert(old, new.where("k = 2"), ["k"], columns=["v"])
    assert rows(part)[(2, "b", 20)] == 1
    with pytest.raises(ValueError):
        merge.upsert(old, new, ["k"], "replace")


def test_upsert_into_rewrites_only_touched_days(spark, table):
    new = spark.createDataFrame([(date(2026, 6, 3), "k3", 300), (date(2026, 6, 20), "n", 1)], "dt date, k string, v long")
    expected = content(spark, table)
    del expected[date(2026, 6, 3), "k3", 3]
    expected.update([(date(2026, 6, 3), "k3", 300), (date(2026, 6, 20), "n", 1)])
    merge.upsert_into(new, table, "dt", ["dt", "k"])
    assert content(spark, table) == expected


def test_delete_from_drops_emptied_days(spark, table):
    merge.delete_from(spark, table, "dt", [Condition("v", "isLess", 3)])
    assert partition_days(spark, table, "dt") == DAYS[2:]
    with pytest.raises(ValueError):
        merge.delete_from(spark, table, "dt", [])


UNDATED = "dt date, k string, v long"


@pytest.fixture
def undated(spark, table):
    spark.createDataFrame([(None, "n1", 1), (None, "n2", 2)], UNDATED).write.mode("append").partitionBy("dt").parquet(table)
    return table


def test_upsert_keeps_stored_rows_without_a_day(spark, undated):
    expected = content(spark, undated) + Counter([(date(2026, 6, 20), "n", 1), (None, "n9", 9)])
    new = spark.createDataFrame([(date(2026, 6, 20), "n", 1), (None, "n9", 9)], UNDATED)
    merge.upsert_into(new, undated, "dt", ["dt", "k"])
    assert content(spark, undated) == expected
    only = spark.createDataFrame([(None, "n10", 10)], UNDATED)
    merge.upsert_into(only, undated, "dt", ["dt", "k"], "ignore")
    assert content(spark, undated) == expected + Counter([(None, "n10", 10)])


def test_delete_reaches_rows_without_a_day(spark, undated):
    merge.delete_from(spark, undated, "dt", [Condition("v", "isLess", 2)])
    assert not [r for r in content(spark, undated) if r[2] < 2]
    merge.delete_from(spark, undated, "dt", [Condition("k", "is", "n2")])
    left = content(spark, undated)
    assert sum(left.values()) == 9 and not [r for r in left if r[0] is None]


def test_upsert_refuses_two_rows_of_one_key_and_writes_nothing(spark, table):
    before = content(spark, table)
    new = spark.createDataFrame([(DAYS[0], "k1", 5), (DAYS[0], "k1", 6)], UNDATED)
    for mode in ("merge", "ignore"):
        with pytest.raises(ValueError, match="two new rows"):
            merge.upsert_into(new, table, "dt", ["dt", "k"], mode)
    assert content(spark, table) == before


def test_upsert_of_some_columns_of_a_stored_table(spark, path):
    rows = spark.createDataFrame([(DAYS[0], "a", 1, "x"), (DAYS[0], "b", 2, "y")], "dt date, k string, v long, s string")
    overwrite_days(rows, path, "dt")
    new = spark.createDataFrame([(DAYS[0], "a", 10)], UNDATED)
    merge.upsert_into(new, path, "dt", ["dt", "k"], columns=["v"])
    got = {(r["k"], r["v"], r["s"]) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 10, "x"), ("b", 2, "y")}


def test_staged_folders_do_not_stay(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "scratch_path", lambda _, label: str(tmp_path / f"staged-{label}"))
    merge.delete_from(spark, table, "dt", [Condition("v", "isLess", 3)])
    merge.upsert_into(spark.createDataFrame([(DAYS[4], "z", 5)], UNDATED), table, "dt", ["dt", "k"])
    assert not list(tmp_path.glob("staged-*"))


def test_partition_column_must_be_a_day(spark, table):
    before = content(spark, table)
    stamped = spark.read.parquet(table).select(F.col("dt").cast("timestamp").alias("dt"), "k", "v")
    with pytest.raises(TypeError):
        replace_window(stamped, table, "dt", DateWindow(date(2026, 6, 10), -9, 0))
    with pytest.raises(TypeError):
        merge.upsert_into(stamped, table, "dt", ["dt", "k"])
    assert content(spark, table) == before


def test_stored_table_is_widened(spark, table):
    new = spark.createDataFrame([(date(2026, 6, 30), "w", "late")], "dt date, k string, remark string")
    assert merge.append_into(new, table, "dt") == [("remark", "string")]
    rows = {(r["k"], r["v"], r["remark"]) for r in merge.read_evolved(spark, table).collect()}
    assert ("w", None, "late") in rows and ("k1", 1, None) in rows and len(rows) == 11


def test_schema_growth(spark):
    old = spark.createDataFrame([(1,)], "a long")
    new = spark.createDataFrame([(2, "x")], "a long, b string")
    assert merge.missing_fields(old.columns, new) == [("b", "string")]
    assert Counter(map(tuple, merge.append_evolving(old, new).collect())) == Counter([(1, None), (2, "x")])


def test_reconcile(spark):
    got = {r["route"]: tuple(r)[1:] for r in reconcile({"a": (spark.range(5), spark.range(3)), "b": (spark.range(2), spark.range(2))}).collect()}
    assert got == {"a": (5, 3, 2), "b": (2, 2, 0), "total": (7, 5, 2)}


def test_event_log(spark):
    log = spark.createDataFrame(
        [("t", "r1", 1, "failed"), ("t", "r1", 2, "success"), ("t", "r2", 1, "success"), ("t", "r2", 3, "failed"), ("t", "r3", 1, None)],
        "target string, row_key string, seq long, status string",
    )
    failed = current_failures(log, ["target", "row_key"], ["seq"], "status")
    assert [r["row_key"] for r in failed.collect()] == ["r2"]
    summary = status_summary(log.withColumn("kind", F.lit("write")), "kind", "status")
    assert dict(map(tuple, summary.collect())) == {"write_failed": 2, "write_success": 2, "write_unknown": 1}
    rows = spark.createDataFrame([("r1", 1), ("r2", 2)], "row_key string, v long")
    assert [r["v"] for r in merge.retry_only(rows, failed).collect()] == [2]


def test_routes_isolate_failures(spark):
    written = {}
    sink = lambda name: lambda df: written.update({name: df.count()})
    routes = [
        Route("ok", "result", sink("ok")),
        Route("bad", "result", sink("bad"), steps=[("boom", lambda df: df.select(F.col("id") / 0).unknown())]),
        Route("late", "result", sink("late"), steps=[("half", lambda df: df.where("id < 5"))]),
        Route("off", "result", sink("off"), enabled=False),
    ]
    with pytest.raises(RoutesFailed, match="1/3 route"):
        routing.run_routes({"result": spark.range(10)}, routes)
    assert written == {"ok": 10, "late": 5}


def test_severity_gate(spark):
    df = spark.createDataFrame([("2024-01-01",), ("soon",)], "day string")
    mapping = {"day": ("day", FieldType.DATE), "gone": ("gone", FieldType.TEXT)}
    run = lambda level: routing.run_routes({"r": df}, [Route("x", "r", lambda d: d.count(), mapping=mapping, level=level)], fail=False)[0]
    assert (run("strict").success, run("strict").n_critical) == (False, 2)
    assert (run("warn").success, run("warn").n_critical) == (True, 2)
    assert (run("skip").success, run("skip").n_critical) == (True, 0)


def test_coercion(spark):
    df = spark.createDataFrame([("1.5", "a, b,", None), ("x", None, "2024-01-02")], "n string, m string, d string")
    mapping = {"n": ("N", FieldType.NUMBER), "m": ("M", FieldType.MULTI_SELECT), "d": ("D", FieldType.DATE)}
    got = [r.asDict(recursive=True) for r in coerce_frame(df, mapping).collect()]
    assert got == [{"N": 1.5, "M": [{"text": "a"}, {"text": "b"}], "D": None}, {"N": None, "M": [], "D": 1704153600000}]
    assert dict(map(tuple, coercion_issues(df, mapping).collect())) == {"N": 1, "M": 0, "D": 0}
    with pytest.raises(KeyError):
        coerce_frame(df, {"zzz": ("Z", FieldType.TEXT)})


def test_mapping_coverage(spark):
    df = spark.createDataFrame([(1, 2.0, "x", "y")], "row_key long, a double, b string, b_bak string")
    target = {"a": FieldType.NUMBER, "c": FieldType.TEXT}
    found = quality.map_to_target(df, target, ["b:c"])
    assert found.coverage == 0.5 and not found.accept() and found.unmatched == ["b_bak"]
    assert found.mapping == {"a": ("a", FieldType.NUMBER), "b": ("c", FieldType.TEXT)}
    grown = quality.map_to_target(df, target, create_missing=True)
    assert grown.to_create == ["b", "b_bak"] and quality.map_to_target(df, None).coverage == 0.0
    with pytest.raises(ValueError):
        quality.parse_override("only")


def test_checks_are_one_pass(spark):
    df = spark.createDataFrame([("2024-01-01", 0.5, "x", "yes"), ("bad", 1.5, None, "maybe"), (None, None, "yy", None)],
                               "d string, p double, t string, c string")
    checks = [
        quality.FieldCheck("d", FieldType.DATE), quality.FieldCheck("p", FieldType.NUMBER, "percent"),
        quality.FieldCheck("t", FieldType.TEXT), quality.FieldCheck("c", FieldType.CHECKBOX),
    ]
    out = quality.check_columns(df, checks)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = {(r["field"], r["check"]): (r["level"], r["n"]) for r in out.collect()}
    assert got[("d", "unparseable_date")] == ("CRITICAL", 1) and got[("p", "outside_unit_range")] == ("WARNING", 1)
    assert got[("c", "checkbox_domain")] == ("WARNING", 1) and ("d", "all_null") not in got
