"""Hand-computed inputs and results for the reject, pricing, key and window rules."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stallworks.operators.reshape import with_row_key
from stallworks.params import DateWindow, SourceOffsets
from stallworks.plans.reports.fusion import dedup_rejects, quality_rejects
from stallworks.plans.reports.pricing import active_rates, pricing_plan, trial_products, with_fee
from stallworks.sources.tables import scan_day, scan_from, scan_window

DAY = date(2026, 6, 18)


@pytest.fixture
def rejects(spark):
    rows = [
        (date(2024, 1, 1), "A001", "banana"),
        (date(2024, 1, 1), "A001", "banana"),
        (date(2024, 1, 2), "A002", "melon"),
        (date(2024, 1, 3), "A003", "grape"),
        (date(2024, 1, 3), "A003", "grape"),
        (date(2024, 1, 8), "A001", "banana"),
    ]
    return spark.createDataFrame(rows, "dt date, goods_id string, category4 string")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_rejects_per_day(rejects):
    got = rows(quality_rejects(rejects).select("dt", "n_rejects", "n_reject_goods", "n_repeat_7d"), "dt")
    assert [r[1:] for r in got] == [(2, 1, 0), (1, 1, 0), (2, 1, 0), (1, 1, 0)]


def test_rejects_after_dedup(rejects):
    got = rows(quality_rejects(dedup_rejects(rejects)).select("dt", "n_rejects"), "dt")
    assert [r[1] for r in got] == [1, 1, 1, 1]


def test_rejects_by_category_have_no_repeat_column(rejects):
    out = quality_rejects(rejects, ["dt", "category4"])
    assert "n_repeat_7d" not in out.columns and out.count() == 4


def test_rejects_from_text_days(rejects):
    text = rejects.withColumn("dt", F.col("dt").cast("string")).withColumn("dt", F.to_date("dt"))
    assert rows(quality_rejects(text), "dt") == rows(quality_rejects(rejects), "dt")


def test_rejects_empty(rejects):
    assert quality_rejects(rejects.where(F.lit(False))).count() == 0


def test_repeat_is_counted(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), "A"), (date(2024, 1, 3), "A"), (date(2024, 1, 7), "B"), (date(2024, 1, 9), "B"),
         (date(2024, 1, 9), None)],
        "dt date, goods_id string",
    )
    got = {r["dt"].day: r["n_repeat_7d"] for r in quality_rejects(df).collect()}
    # A: 1 and 3 lie in [1, 7] but not both in [3, 9]; B: 7 and 9 lie in [3, 9].
    assert got == {1: 0, 3: 1, 7: 1, 9: 1}


@pytest.fixture
def pricing(spark):
    before = date(2026, 6, 17)
    goods = spark.createDataFrame(
        [(before, 9, 101, "SKU001", "n1", "c1", 0.05, 1.0), (before, 9, 102, "SKU002", "n2", "c2", 0.08, 2.0),
         (before, 9, 103, "SKU003", "n3", "c3", 0.10, 0.5)],
        "dt date, mall_id long, goods_id long, goods_code string, goods_name string, category string, base_rate double, gross_weight double",
    )
    trial = spark.createDataFrame([(101, DAY, 0.12), (102, DAY, 0.15), (200, DAY, 0.20)], "goods_id long, dt date, base_rate double")
    kinds = ["自营区域", "代理人区域", "自营区域", "自营区域", "自营区域"]
    county = spark.createDataFrame(
        [(DAY, 1000 + i, f"r{i}", 100 * i, 10 * i, i, k) for i, k in enumerate(kinds, 1)],
        "dt date, region_id long, region_name string, county_id long, city_id long, province_id long, operation_type string",
    )
    rates = spark.createDataFrame(
        [("101", 10, "g1", 0.03, 0.02, "2026-06-01", "2026-06-30", 1), ("101", 20, "g2", 0.07, 0.06, "2026-06-01", "2026-06-30", 2),
         ("102", 20, "g2", 0.08, 0.09, "2026-06-01", "2026-06-30", 3)],
        "goods_id string, city_id long, trial_group string, self_rate double, agent_rate double, start_day string, end_day string, seq long",
    )
    logistics = spark.createDataFrame(
        [(DAY, 10, 0.01, '{"100": 0.005}'), (DAY, 20, 0.02, ""), (DAY, 30, 0.015, '{"999": 0.03}')],
        "dt date, city_id long, fee_rate double, county_fee_json string",
    )
    return {"goods": goods, "trial_goods": trial, "county": county, "trial_rate": rates, "logistics": logistics}


def test_trial_products(pricing):
    got = rows(trial_products(pricing["goods"], pricing["trial_goods"], DAY).select("goods_id", "base_rate"), "goods_id")
    assert got == [(101, 0.12), (102, 0.15)]


def test_fee_override_city_and_missing(pricing):
    got = dict(rows(with_fee(pricing["county"], pricing["logistics"], DAY).select("city_id", "fee"), "city_id"))
    assert got == {10: 0.005, 20: 0.02, 30: 0.015, 40: None, 50: None}


def test_rates_keep_last_and_respect_validity(spark, pricing):
    more = spark.createDataFrame(
        [("101", 10, None, 0.5, 0.6, "2026-06-01", "2026-06-30", 9), ("102", 30, "x", 0.1, 0.1, "2026-07-01", "2026-07-30", 10),
         ("bad", 30, "x", 0.1, 0.1, "2026-06-01", "2026-06-30", 11)],
        pricing["trial_rate"].schema,
    )
    got = rows(active_rates(pricing["trial_rate"].unionByName(more), DAY, "seq"), "goods_id", "city_id")
    assert got == [(101, 10, "", 0.5, 0.6), (101, 20, "g2", 0.07, 0.06), (102, 20, "g2", 0.08, 0.09)]


def test_pricing_plan(pricing):
    plan = pricing_plan(pricing, DAY, percent=False)
    got = {
        (r["goods_id"], r["region_id"] - 1000): (r["is_trial"], r["ratio"], r["value"], r["direction"], r["trial_group"])
        for r in plan.collect()
    }
    want = {
        (101, 1): (1, 0.09, None, "降价", "g1"),
        (101, 2): (1, 0.06, None, "降价", "g2"),
        (101, 3): (0, None, 0.015, "涨价", ""),
        (102, 1): (0, None, 0.010, "涨价", ""),
        (102, 2): (1, 0.06, None, "降价", "g2"),
        (102, 3): (0, None, 0.030, "涨价", ""),
    }
    assert got.keys() == want.keys()
    for key, (trial, ratio, value, direction, group) in want.items():
        assert got[key][0] == trial and got[key][3:] == (direction, group)
        assert got[key][1] == pytest.approx(ratio) if ratio else got[key][1] is None
        assert got[key][2] == pytest.approx(value) if value else got[key][2] is None


def test_pricing_output_columns_and_percent(pricing):
    plan = pricing_plan(pricing, DAY)
    assert plan.columns[:11] == [
        "region_id", "region_name", "goods_code", "goods_name", "direction", "adjustment", "status", "ratio", "value",
        "goods_id", "category",
    ]
    assert max(r["ratio"] or 0 for r in plan.collect()) == pytest.approx(9.0)


def test_pricing_without_goods(pricing):
    assert pricing_plan({**pricing, "goods": pricing["goods"].where(F.lit(False))}, DAY).count() == 0


@pytest.mark.parametrize("self_rate,base,want", [(0.03, 0.05, "降价"), (0.05, 0.02, "涨价"), (0.03, 0.03, "不变")])
def test_direction(spark, pricing, self_rate, base, want):
    t = dict(pricing)
    t["trial_goods"] = spark.createDataFrame([(101, DAY, base)], "goods_id long, dt date, base_rate double")
    t["trial_rate"] = pricing["trial_rate"].where("city_id = 10").withColumn("self_rate", F.lit(self_rate))
    got = [r["direction"] for r in pricing_plan(t, DAY).where("is_trial = 1").collect()]
    assert got == [want]


def test_row_keys(spark):
    df = spark.createDataFrame(
        [(1001, date(2026, 6, 20)), (1002, date(2026, 6, 21)), (1003, date(2026, 6, 22))], "store_id long, dt date"
    )
    keys = [r["row_key"] for r in with_row_key(df, ["store_id", "dt"]).orderBy("store_id").collect()]
    assert keys == ["1001_2026-06-20", "1002_2026-06-21", "1003_2026-06-22"]
    with pytest.raises(ValueError):
        with_row_key(df, ["store_id", "missing"])


def test_row_key_refuses_missing_parts(spark):
    df = spark.createDataFrame([(None, date(2026, 6, 20))], "store_id long, dt date")
    with pytest.raises(Exception, match="empty row key"):
        with_row_key(df, ["store_id", "dt"]).collect()


def test_windows():
    base = date(2026, 6, 26)
    week, older = DateWindow(base, -7, 0), DateWindow(base, -14, -1)
    assert (week.first, week.last) == (date(2026, 6, 19), base)
    assert (older.first, older.last) == (date(2026, 6, 12), date(2026, 6, 25))
    assert DateWindow(base, -7, 0, buffer=2).cleanup().first == date(2026, 6, 17)
    assert week.n_days == 8 and week.days()[0] == week.first
    with pytest.raises(ValueError):
        DateWindow(base, 1, 0)
    assert SourceOffsets(-3).bounds(week) == (date(2026, 6, 16), None)
    assert SourceOffsets(0, 1).bounds(week) == (week.first, date(2026, 6, 27))


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_window_scan_on_every_day_type(spark, kind):
    days = [date(2026, 5, 26 + i) if i < 6 else date(2026, 6, i - 5) for i in range(22)]
    df = spark.createDataFrame([(str(d), d) for d in days], "text string, dt date")
    stamped = F.concat(F.col("dt").cast("string"), F.lit(" 13:30:00"))
    value = F.col("dt").cast("string") if kind == "string" else (F.col("dt") if kind == "date" else stamped.cast(kind))
    df = df.withColumn("dt", value)
    window = DateWindow(date(2026, 6, 9), -7, 0)
    got = [r["text"] for r in scan_window(df, "dt", window).orderBy("text").collect()]
    assert got == [f"2026-06-{d:02d}" for d in range(2, 10)]
    assert scan_from(df, "dt", window, SourceOffsets()).count() == 15
    assert [r["text"] for r in scan_day(df, "dt", window.base, 1).collect()] == ["2026-06-08"]


def test_normalised_days(spark):
    from pyspark.sql import types as T

    from stallworks.functions.dates import millis_to_day, normalise_day, value_to_millis

    row = spark.range(1).select(
        normalise_day(F.lit(46167), T.IntegerType()).alias("serial"),
        normalise_day(F.lit("2026/05/25 10:11:12"), T.StringType()).alias("text"),
        normalise_day(F.lit("not a day"), T.StringType()).alias("bad"),
        value_to_millis(F.lit(1_750_000_000), T.LongType()).alias("seconds"),
        value_to_millis(F.lit(1_750_000_000_000), T.LongType()).alias("millis"),
        value_to_millis(F.lit(datetime(2026, 5, 25, 23, 59)).cast("timestamp_ntz"), T.TimestampNTZType()).alias("stamp"),
        millis_to_day(F.lit(1_781_712_000_000), 8).alias("east"),
        millis_to_day(F.lit(1_781_712_000_000)).alias("utc"),
    ).first()
    assert row["serial"] == row["text"] == date(2026, 5, 25) and row["bad"] is None
    assert row["seconds"] == row["millis"] == 1_750_000_000_000
    assert row["stamp"] == 1_779_667_200_000
    assert (row["east"], row["utc"]) == (date(2026, 6, 18), date(2026, 6, 17))


def test_route_row_keys(spark):
    from stallworks.plans.rules import ROW_KEYS, row_key_columns

    assert {len(v) for v in ROW_KEYS.values()} == {1, 2, 3, 4, 5}
    df = spark.createDataFrame([(7, "c1", "c4", 5, date(2026, 6, 20))], "merchant_id long, cat1 string, cat4 string, sku_id long, dt date")
    got = with_row_key(df, row_key_columns("sku_stat_detail")).first()["row_key"]
    assert got == "7_c1_c4_5_2026-06-20"
    with pytest.raises(ValueError):
        row_key_columns("other")
