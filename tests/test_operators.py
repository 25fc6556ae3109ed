"""Operators against brute force, and what happens to skewed or dirty input."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stallworks.functions import adjust, text, values
from stallworks.functions.predicates import Condition, day_window, predicate
from stallworks.operators import joins, metrics, ranking, reshape
from stallworks.operators.hierarchy import flatten_hierarchy
from stallworks.operators.metrics import Metrics, aggregate
from stallworks.operators.rolling import Band, repeat_entities, rolling_by_spine, spine_expand
from stallworks.params import DateWindow

START = date(2024, 3, 1)
WINDOW = DateWindow.of_days(START + timedelta(days=10), START + timedelta(days=40))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(5)
    rows = {}
    for _ in range(400):
        key, day = rng.choice("abcdef"), START + timedelta(days=rng.randrange(60))
        rows[key, day] = (key, day, rng.randrange(9), rng.random() < 0.5)
    return list(rows.values())


BANDS = [Band("w", 0, 6), Band("p", 7, 13), Band("m", 0, 20)]


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_rolling_equals_brute_force(spark, facts, direction):
    df = spark.createDataFrame([(k, d, x, int(a)) for k, d, x, a in facts], "k string, dt date, x long, a int")
    out = rolling_by_spine(df, ["k"], "dt", WINDOW, ["x"], BANDS, {"act": F.col("a") == 1}, direction=direction)
    got = {(r["k"], r["dt"]): r.asDict() for r in out.collect()}
    want = {}
    for t in WINDOW.days():
        for k in "abcdef":
            gap = lambda d: (t - d).days if direction == "backward" else (d - t).days
            near = [(gap(d), x, a) for kk, d, x, a in facts if kk == k and 0 <= gap(d) <= 20]
            if not near:
                continue
            row = {"k": k, "dt": t, "x": sum(x for g, x, _ in near if g == 0)}
            for b in BANDS:
                inside = [(x, a) for g, x, a in near if b.near <= g <= b.far]
                row[f"x_{b.name}"] = sum(x for x, _ in inside)
                row[f"act_{b.name}"] = sum(a for _, a in inside)
            want[k, t] = row
    assert got == want


def test_rolling_shuffles_the_facts_once(spark, facts):
    df = spark.createDataFrame([(k, d, x) for k, d, x, _ in facts], "k string, dt date, x long")
    plan = rolling_by_spine(df, ["k"], "dt", WINDOW, ["x"], BANDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_spine_expand_equals_range_join(spark, facts):
    df = spark.createDataFrame([(k, d) for k, d, _, _ in facts], "k string, dt date")
    got = bag(spine_expand(df, "dt", WINDOW, 0, 6).select("k", "dt", "spine_dt"))
    want = Counter((k, d, t) for k, d, _, _ in facts for t in WINDOW.days() if 0 <= (t - d).days <= 6)
    assert got == want


def test_repeat_entities_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(START + timedelta(days=rng.randrange(30)), rng.choice("abcdefgh")) for _ in range(120)]
    df = spark.createDataFrame(rows, "dt date, e string")
    got = {r["dt"]: r["n_repeat"] for r in repeat_entities(df, "dt", "e").collect()}
    want = {}
    for t in {d for d, _ in rows}:
        days = defaultdict(set)
        for d, e in rows:
            if 0 <= (t - d).days <= 6:
                days[e].add(d)
        want[t] = sum(len(s) > 1 for s in days.values())
    assert got == want


def test_aggregate_equals_plain_counts(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([None, "x", "y"]), rng.choice([None, 1, 2, 3]), rng.choice([None, "p", "q"]), rng.choice([None, 1, 5]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "g string, e long, f string, v long")
    big = F.col("v") > 2
    got = aggregate(
        df, ["g"],
        Metrics(
            sums={"s": F.col("v")}, maxima={"m": F.col("v")},
            distincts={"e_all": ("e", None), "e_big": ("e", big), "f_big": ("f", big)},
        ),
    )
    want = df.groupBy("g").agg(
        F.sum("v").alias("s"), F.max("v").alias("m"), F.countDistinct("e").alias("e_all"),
        F.countDistinct(F.when(big, F.col("e"))).alias("e_big"), F.countDistinct(F.when(big, F.col("f"))).alias("f_big"),
    )
    assert bag(got) == bag(want.select(*got.columns))


def test_distinct_counts_need_no_expand(spark):
    df = spark.range(10).select(F.col("id").alias("e"), (F.col("id") > 3).alias("c"))
    out = aggregate(df, [], Metrics(distincts={f"n{i}": ("e", F.col("e") > i) for i in range(8)}))
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_equals_join(spark, how):
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i % 40, i % 5) for i in range(3000)]
    fact = spark.createDataFrame(rows, "k long, v long")
    dim = spark.createDataFrame([(i, f"d{i}") for i in range(0, 40, 2)] + [(7, "a"), (7, "b")], "k long, name string")
    got = joins.hot_key_join(fact, dim, ["k"], how, hot_share=0.1, parts=8)
    assert bag(got.select("k", "v", "name")) == bag(fact.join(dim, ["k"], how).select("k", "v", "name"))


def test_hot_key_rows_spread(spark):
    fact = spark.createDataFrame([(1, i) for i in range(2000)], "k long, v long").repartition(4)
    dim = spark.createDataFrame([(1, "x")], "k long, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.hot_key_join(fact, dim, ["k"], hot_share=0.5, parts=16)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and max(sizes) < 1500


def test_grid_product_is_whole_and_not_cartesian(spark):
    left = spark.createDataFrame([(i,) for i in range(7)], "a long")
    right = spark.createDataFrame([(i,) for i in range(100)], "b long")
    grid = joins.grid_product(left, right, blocks=4)
    assert grid.count() == grid.distinct().count() == 700
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("how", ["left", "right", "inner", "outer", "cross"])
def test_declarative_merge_row_counts(spark, how):
    pool = {
        "config:a": spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k long, v string"),
        "warehouse:b": spark.createDataFrame([(1, "p"), (3, "q"), (None, "r")], "k long, v string"),
    }
    spec = {"left": "config:a", "right": "warehouse:b", "how": how, "suffixes": ("_a", "_b")}
    if how != "cross":
        spec["on"] = "k"
    out = joins.declarative_merge(pool, spec)
    assert out.count() == {"left": 3, "right": 3, "inner": 2, "outer": 4, "cross": 9}[how]
    assert {"v_a", "v_b"} <= set(out.columns)


def test_declarative_merge_refuses_bad_specs(spark):
    pool = {"config:a": spark.range(1)}
    with pytest.raises(KeyError):
        joins.declarative_merge(pool, {"left": "config:a", "right": "warehouse:none", "on": "id"})
    with pytest.raises(ValueError):
        joins.declarative_merge(pool, {"left": "config:a", "right": "config:a"})
    with pytest.raises(ValueError):
        joins.declarative_merge(pool, {"right": "config:a", "on": "id"})


def test_duplicate_dimension_keys_are_found(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    assert [tuple(r) for r in joins.duplicate_keys(dim, ["k"]).collect()] == [(1, 2)]


def test_rank_before_filter(spark):
    df = spark.createDataFrame([("g", 1, 5), ("g", 2, 9), ("g", 3, None)], "g string, mall long, v long")
    kept = ranking.rank_then_keep(df, ["g"], {"r": "v"}, ["mall"], F.col("mall") == 1)
    assert [r["r"] for r in kept.collect()] == [2]


def test_top_k_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = ranking.top_k(df, ["g"], [F.col("id").desc()], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_one_per_key_needs_an_order_and_no_window(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 5, "b"), (2, 1, None)], "k long, o long, v string")
    out = ranking.one_per_key(df, ["k"], ["o"])
    assert bag(out) == Counter([(1, 5, "b"), (2, 1, None)])
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        ranking.one_per_key(df, ["k"], [])


def test_hierarchy_with_broken_chains(spark):
    rows = [(1, None, 0, "P"), (2, 1, 1, "C"), (3, 2, 2, "T"), (4, 99, 2, "orphan"), (5, 1, 2, "skips a level")]
    df = spark.createDataFrame(rows, "id long, up long, lvl int, name string")
    flat = flatten_hierarchy(df, ["prov", "city", "town"], "id", "up", "lvl", "name")
    got = {r["id"]: (r["prov_id"], r["city_id"], r["town_id"]) for r in flat.collect()}
    assert got == {1: (1, None, None), 2: (1, 2, None), 3: (1, 2, 3), 4: (None, None, 4), 5: (None, None, 5)}


def test_collect_map_is_distinct_and_sorted(spark):
    df = spark.createDataFrame([(1, "b", "y"), (1, "b", "x"), (1, "b", "x"), (1, "a", "z"), (1, None, "z")], "g long, k string, v string")
    assert metrics.collect_map(df, ["g"], "k", "v").first()["items"] == {"a": ["z"], "b": ["x", "y"]}


def test_predicates(spark):
    df = spark.createDataFrame(
        [(1, "apple", date(2024, 1, 1)), (2, None, date(2024, 1, 2)), (3, " ", date(2024, 1, 3))], "n long, s string, d date"
    )
    ids = lambda *c, join="and": sorted(r["n"] for r in df.where(predicate(list(c), join)).collect())
    assert ids(Condition("s", "isEmpty")) == [2, 3] and ids(Condition("s", "isNotEmpty")) == [1]
    assert ids(Condition("s", "contains", "pp")) == [1] and ids(Condition("s", "doesNotContain", "pp")) == [3]
    assert ids(Condition("n", "isGreater", 1)) == [2, 3] and ids(Condition("n", "isLessEqual", 1)) == [1]
    assert ids(*day_window("d", date(2024, 1, 2), date(2024, 1, 3))) == [2, 3]
    assert ids(Condition("n", "is", 1), Condition("n", "isGreaterEqual", 3), join="or") == [1, 3]
    assert ids(Condition("n", "isNot", 1), Condition("d", "isLess", date(2024, 1, 3))) == [2]
    with pytest.raises(ValueError):
        predicate([])
    with pytest.raises(ValueError):
        Condition("n", "like", 1)


def test_adjustments(spark):
    row = spark.range(1).select(
        adjust.offset_rate(F.lit(0.056), 0.07, 0.086).alias("a"),
        adjust.offset_rate(F.lit(0.092), 0.07, 0.086).alias("b"),
        adjust.offset_rate(F.lit(0.092), 0.07, 0.086, keep_above=True).alias("c"),
        adjust.ladder_rate(F.lit(0.3), [0.3, 0.5, 0.7], [0.1, 0.2, 0.3]).alias("d"),
        adjust.ladder_rate(F.lit(0.9), [0.3, 0.5, 0.7], [0.1, 0.2, 0.3, 0.4]).alias("e"),
        adjust.ladder_rate(F.lit(0.9), [0.3, 0.5, 0.7], [0.1, 0.2, 0.3]).alias("f"),
        adjust.shifted_rate(F.lit(0.9), 0.2).alias("g"),
    ).first()
    assert row["a"] == pytest.approx(0.0804186046511628) and row["b"] == pytest.approx(0.08711627906976743)
    assert (row["c"], row["d"], row["e"], row["f"], row["g"]) == (0.092, 0.1, 0.4, 0.3, None)
    with pytest.raises(ValueError):
        adjust.ladder_rate(F.lit(1.0), [0.1], [0.1, 0.2, 0.3])


def test_null_and_zero_semantics(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (1.0, 8.0)], "a double, b double")
    got = [tuple(r) for r in df.select(values.ratio("a", "b"), values.raw_ratio("a", "b"), values.flag(F.col("a") > 0)).collect()]
    assert got == [(0.0, None, 1), (0.0, None, 0), (0.125, 0.125, 1)]


def test_attachment_cells(spark):
    cells = [None, "", " http://a/x.png ", '["http://a/1", "ftp://b", "https://c"]', "['http://a/1)']", "[oops", "http://", "[1"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r["u"] for r in df.select("i", text.attachment_urls("c").alias("u")).orderBy("i").collect()]
    assert got == [[], [], ["http://a/x.png"], ["http://a/1", "https://c"], ["http://a/1"], [], [], []]


def test_unpivot_without_flag_columns(spark):
    df = spark.createDataFrame([(1, "是")], "k long, f string")
    assert reshape.unpivot_flags(df, ["k"], {"absent": "x"}, "label", "mark").count() == 0
    assert bag(reshape.unpivot_flags(df, ["k"], {"f": "x"}, "label", "mark")) == Counter([(1, "x", 1)])


def test_text_change_treats_missing_as_empty(spark):
    df = spark.createDataFrame([(None, None), (None, ""), ("a", None), ("a", "a")], "x string, y string")
    assert [r[0] for r in df.select(ranking.text_changed("x", "y")).collect()] == [False, False, True, False]
