"""Stages, lookups, alerts and power inputs on cases worked out by hand."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stallworks.operators.calendar import asof_lookup, check_stages, stage_calendar
from stallworks.params import DateWindow
from stallworks.plans.reports import trial

STAGE = "stage string, first date, last date, grain string"
D = date


def stages(spark, *rows):
    return spark.createDataFrame(list(rows), STAGE)


def no_holidays(spark):
    return spark.createDataFrame([], "day date")


@pytest.mark.parametrize(
    "rows",
    [
        [("a", D(2026, 1, 1), D(2026, 1, 10), "day"), ("b", D(2026, 1, 10), D(2026, 1, 20), "week")],
        [("a", D(2026, 1, 1), D(2026, 3, 1), "day"), ("b", D(2026, 1, 5), D(2026, 1, 6), "week"), ("c", D(2026, 2, 1), D(2026, 2, 2), "whole")],
        [("a", D(2026, 1, 10), D(2026, 1, 1), "day")],
        [("a", D(2026, 1, 1), D(2026, 1, 1), "month")],
    ],
)
def test_stages_that_overlap_or_make_no_sense_are_refused(spark, rows):
    with pytest.raises(ValueError, match="stage"):
        check_stages(stages(spark, *rows))


def test_weeks_start_with_the_stage_and_holidays_do_not_count(spark):
    off = spark.createDataFrame([(D(2026, 6, 19),), (D(2026, 6, 20),), (D(2026, 6, 20),), (None,)], "day date")
    plan = stages(
        spark, ("pre", D(2026, 6, 1), D(2026, 6, 2), "day"), ("base", D(2026, 6, 15), D(2026, 6, 24), "whole"),
        ("effect", D(2026, 6, 25), D(2026, 7, 12), "week"),
    )
    rows = stage_calendar(plan, off, D(2026, 7, 10)).select(
        "stage", "stage_week", "period_first", "period_last", "is_complete_week", "trading_days"
    ).distinct()
    got = {(r[0], r[2]): (r[1], r[3], r[4], r[5]) for r in rows.collect()}
    assert got == {
        ("pre", D(2026, 6, 1)): (None, D(2026, 6, 1), None, 1),
        ("pre", D(2026, 6, 2)): (None, D(2026, 6, 2), None, 1),
        ("base", D(2026, 6, 15)): (None, D(2026, 6, 24), None, 8),
        ("effect", D(2026, 6, 25)): ("effect_W1", D(2026, 7, 1), True, 7),
        ("effect", D(2026, 7, 2)): ("effect_W2", D(2026, 7, 8), True, 7),
        ("effect", D(2026, 7, 9)): ("effect_W3", D(2026, 7, 12), False, 2),
    }


def test_a_period_after_the_last_seen_day_has_no_trading_days(spark):
    plan = stages(spark, ("effect", D(2026, 1, 1), D(2026, 1, 14), "week"))
    rows = stage_calendar(plan, no_holidays(spark), D(2026, 1, 7)).select("period_first", "is_complete_week", "trading_days").distinct()
    assert sorted(map(tuple, rows.collect())) == [(D(2026, 1, 1), True, 7), (D(2026, 1, 8), False, 0)]


def test_latest_entry_on_or_before_the_day(spark):
    entries = spark.createDataFrame(
        [("a", D(2026, 1, 2), 1), ("a", D(2026, 1, 5), 2), ("a", D(2026, 1, 5), 3), ("b", D(2026, 1, 9), 9), (None, D(2026, 1, 1), 7), ("a", None, 8)],
        "k string, d date, v int",
    )
    probes = spark.createDataFrame(
        [("a", D(2026, 1, i)) for i in (1, 2, 4, 5, 5, 8)] + [("b", D(2026, 1, 8)), (None, D(2026, 1, 3))], "k string, d date"
    )
    got = {(r["k"], r["d"].day): (r["as_of"] and r["as_of"].day, r["v"]) for r in asof_lookup(probes, entries, ["k"], "d", ["v"]).collect()}
    assert got == {
        ("a", 1): (None, None), ("a", 2): (2, 1), ("a", 4): (2, 1), ("a", 5): (5, 3), ("a", 8): (5, 3), ("b", 8): (None, None), (None, 3): (1, 7),
    }


def weeks(spark, *rows):
    schema = "stage_week string, period_first date, is_complete_week boolean, order_count long, active_store_count long"
    df = spark.createDataFrame([(f"effect_W{n}", D(2026, 1, 1) + timedelta(days=7 * (n - 1)), ok, o, s) for n, ok, o, s in rows], schema)
    return df.select(
        "*", F.lit("sku").alias("level"), F.lit("effect").alias("stage"), F.lit("c").alias("city_unit"), F.lit("G0").alias("trial_group"),
        F.lit("x").alias("sku_id"), F.lit(7).alias("trading_days"), F.lit(0.0).alias("stockout_num"),
    )


def test_alerts_take_the_last_complete_week_as_base(spark):
    rows = weeks(
        spark, (1, True, 100, 100), (2, True, 90, 100), (3, True, 80, 95), (4, False, 10, 10), (6, True, 70, 94), (7, True, 60, 94), (8, True, 60, 84)
    )
    got = [(r["stage_week"], r["base_first"] and r["base_first"].day, r["order_count_wow"], r["alert"])
           for r in trial.week_alerts(rows, trial.TrialRules()).orderBy("period_first").collect()]
    assert got == [
        ("effect_W1", None, None, "NONE"),
        ("effect_W2", 1, -0.1, "GREEN"),  # not below the bound
        ("effect_W3", 8, -0.111111, "YELLOW"),
        ("effect_W4", 15, None, "GRAY"),
        ("effect_W6", 15, -0.125, "YELLOW"),  # week 4 is incomplete, week 5 has no rows
        ("effect_W7", 5, -0.142857, "YELLOW"),
        ("effect_W8", 12, 0.0, "RED"),  # stores fall by more than a tenth
    ]


FACT = ("dt date, region_id long, sku_id string, store_id long, order_item_id string, ordered_num decimal(12,2), delivered_num decimal(14,4), "
        "delivered_amt decimal(12,2), commission_amt decimal(14,4), list_price decimal(14,2), is_valid int")
DESIGN = [(1, "A", "self", "G0", 1), (2, "A", "self", "G0", 1), (3, "B", "agent", "G1", 1), (9, "Z", "self", "G0", 0)]


def fact(day, region, sku, store, item, amount, ordered=1, delivered=1, commission=0, price=10, valid=1):
    return (day, region, sku, store, item, *map(Decimal, (ordered, delivered, amount, commission, price)), valid)


def setting(spark, rows):
    facts = spark.createDataFrame(rows, FACT)
    return facts, spark.createDataFrame(DESIGN, "region_id long, city_unit string, region_type string, trial_group string, in_trial int")


def test_grain_follows_the_stage_and_a_store_counts_once_in_a_city(spark):
    plan = stages(spark, ("pre", D(2026, 1, 1), D(2026, 1, 2), "day"), ("base", D(2026, 1, 3), D(2026, 1, 9), "whole"), ("effect", D(2026, 1, 10), D(2026, 1, 20), "week"))
    rows = [
        fact(D(2026, 1, 1), 1, "x", 1, "i1", 100, commission=10), fact(D(2026, 1, 1), 2, "y", 1, "i2", 50), fact(D(2026, 1, 2), 1, "x", 1, "i3", 5),
        fact(D(2026, 1, 3), 1, "x", 1, "i4", 10, 5, 3), fact(D(2026, 1, 9), 2, "y", 1, "i5", 20, 1, 2), fact(D(2026, 1, 9), 2, "y", 2, "i5", 20),
        fact(D(2026, 1, 9), 2, "x", 1, "i5", 20),
        fact(D(2026, 1, 17), 3, "x", 7, "i6", 30), fact(D(2026, 1, 17), 3, "x", 7, "i6", 30),
        fact(D(2026, 1, 17), 9, "x", 8, "i7", 30), fact(D(2026, 1, 17), 3, "z", 8, "i8", 30), fact(D(2026, 1, 17), 3, "x", 8, "i9", 30, valid=0),
    ]
    facts, design = setting(spark, rows)
    rates = spark.createDataFrame([("pre", "G0", "self", 0.075), ("effect", "G1", "agent", 0.05)], "stage string, trial_group string, region_type string, rate double")
    goods = spark.createDataFrame([("x", "o", "g", 1), ("y", "p", "h", 2)], "sku_id string, sku_origin string, sku_grade string, sku_weight_spec int")
    calendar = stage_calendar(plan, no_holidays(spark), D(2026, 1, 20))
    wide = trial.wide_table(facts, calendar, design, rates, goods, ["x", "y"], DateWindow.of_days(D(2026, 1, 1), D(2026, 1, 20)))
    got = {
        (r["level"], r["stage"], r["period_first"].day, r["city_unit"], r["sku_id"]): (r["order_count"], r["active_store_count"], r["gmv"], r["stockout_num"], r["target_r0"])
        for r in wide.collect()
    }
    assert got == {
        ("city", "pre", 1, "A", None): (2, 1, 150.0, 0.0, 0.075),
        ("city", "pre", 2, "A", None): (1, 1, 5.0, 0.0, 0.075),
        ("sku", "base", 3, "A", "x"): (2, 1, 30.0, 2.0, None),
        ("sku", "base", 3, "A", "y"): (2, 2, 40.0, 0.0, None),  # one item number of two stores
        ("city", "base", 3, "A", None): (3, 2, 70.0, 2.0, None),  # store 1 bought both goods under one number
        ("sku", "effect", 17, "B", "x"): (1, 1, 60.0, 0.0, 0.05),
        ("city", "effect", 17, "B", None): (1, 1, 60.0, 0.0, 0.05),
    }
    first = wide.where("stage = 'pre' AND period_first = DATE '2026-01-01'").first()
    assert (first["commission_rate"], first["supply_price"]) == (0.066667, 9.3333)
    plan_text = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("Expand") == 1


def test_power_inputs_by_hand_fallback_and_undefined_cases(spark):
    history = [D(2026, 4, 13), D(2026, 4, 20), D(2026, 5, 11), D(2026, 5, 18)]
    fallback = DateWindow.of_days(D(2026, 6, 1), D(2026, 6, 16))  # two whole weeks and two days
    a, b = [100, 120, 110, 90], [50, 70, 60, 40]
    rows = [fact(d, 1, "x", 1, f"a{d}", v) for d, v in zip(history, a)] + [fact(d, 3, "x", 1, f"b{d}", v) for d, v in zip(history, b)]
    rows += [fact(D(2026, 4, 13), 1, "y", 1, "y1", 10), fact(D(2026, 6, 1), 1, "y", 1, "y2", 10), fact(D(2026, 6, 14), 1, "y", 1, "y3", 30),
             fact(D(2026, 6, 16), 1, "y", 1, "y4", 1000), fact(D(2026, 6, 10), 3, "y", 1, "y5", 20)]
    facts, design = setting(spark, rows)
    got = {r["sku_id"]: r for r in trial.power_inputs(facts, design, ["x", "y", "z"], history, fallback, trial.TrialRules()).collect()}
    cv = lambda v: (sum((x - sum(v) / len(v)) ** 2 for x in v) / (len(v) - 1)) ** 0.5 / (sum(v) / len(v))
    sigma = (cv(a) + cv(b)) / 2
    assert got["x"]["basis"] == "history" and got["x"]["history_weeks"] == 4 and got["x"]["n_cities"] == 2
    assert got["x"]["sigma_raw"] == round(sigma, 6) and got["x"]["sigma_adjusted"] == round(1.5 * sigma, 6)
    assert (got["x"]["rho_pre"], got["x"]["rho_post"], got["x"]["rho_main"]) == (1.0, 1.0, 1.0)
    assert abs(got["x"]["n_required"]) < 1e-3 and got["x"]["verdict"] == "sufficient"
    y = got["y"]
    assert (y["basis"], y["history_weeks"], y["n_weeks"]) == ("fallback", 1, 2)
    assert y["sigma_raw"] == round((cv([10, 30]) + cv([0, 20])) / 2, 6) and y["rho_pre"] == 1.0
    z = got["z"]
    assert (z["basis"], z["sigma_raw"], z["rho_main"], z["n_required"], z["verdict"]) == ("fallback", None, None, None, "undefined")


def test_power_inputs_of_one_city_have_no_correlation(spark):
    history = [D(2026, 4, 13), D(2026, 4, 20), D(2026, 5, 11), D(2026, 5, 18)]
    facts, _ = setting(spark, [fact(d, 1, "x", 1, str(d), 10 + i) for i, d in enumerate(history)])
    design = spark.createDataFrame(DESIGN[:1], "region_id long, city_unit string, region_type string, trial_group string, in_trial int")
    row = trial.power_inputs(facts, design, ["x"], history, DateWindow.of_days(D(2026, 6, 1), D(2026, 6, 14)), trial.TrialRules()).first()
    assert row["sigma_raw"] is not None and row["rho_main"] is None and row["verdict"] == "undefined"


def test_correlated_goods_name_each_other(spark):
    history = [D(2026, 4, 13), D(2026, 4, 20), D(2026, 5, 11), D(2026, 5, 18)]
    rows = []
    for i, d in enumerate(history):
        rows += [fact(d, 1, "x", 1, f"x{i}", 10 + i), fact(d, 3, "x", 1, f"X{i}", 50 - i)]
        rows += [fact(d, 1, "y", 1, f"y{i}", 20 + 2 * i), fact(d, 3, "y", 1, f"Y{i}", 100 - 2 * i)]
        rows += [fact(d, 1, "w", 1, f"w{i}", 90 - i), fact(d, 3, "w", 1, f"W{i}", 5 + i)]
    facts, design = setting(spark, rows)
    got = trial.power_inputs(facts, design, ["x", "y", "w"], history, DateWindow.of_days(D(2026, 6, 1), D(2026, 6, 14)), trial.TrialRules())
    assert {r["sku_id"]: r["correlated_skus"] for r in got.collect()} == {"x": "y", "y": "x", "w": ""}


def test_rates_prices_and_their_alerts(spark):
    calendar = stage_calendar(stages(spark, ("effect", D(2026, 1, 1), D(2026, 1, 31), "week")), no_holidays(spark), D(2026, 1, 31))
    _, design = setting(spark, [fact(D(2026, 1, 1), 1, "x", 1, "i", 1)])
    rates = spark.createDataFrame([("effect", "G0", "self", 0.07), ("effect", "G1", "agent", 0.046)], "stage string, trial_group string, region_type string, rate double")
    entries = spark.createDataFrame(
        [("x", 1, D(2026, 1, 2), 0.072, "inside"), ("x", 1, D(2026, 1, 4), 0.076, "outside"), ("x", 3, D(2026, 1, 1), 0.075, "inside")],
        "sku_id string, region_id long, dt date, configured_rate double, participate_type string",
    )
    active = spark.createDataFrame([("x", 1, D(2026, 1, i)) for i in (1, 3, 5)] + [("x", 3, D(2026, 1, 9)), ("x", 9, D(2026, 1, 9))], "sku_id string, region_id long, dt date")
    audit = trial.rate_audit(active, entries, calendar, design, rates, trial.TrialRules())
    got = {(r["region_id"], r["dt"].day): (r["deviation"], r["alerts"], r["status"]) for r in audit.collect()}
    assert got == {
        (1, 1): (None, "NOT_CONFIGURED", "RED"),
        (1, 3): (0.002, "", "OK"),
        (1, 5): (0.006, "RATE_DEVIATION,OUTSIDE_TRIAL", "RED"),
        (3, 9): (0.029, "RATE_DEVIATION,AGENT_AT_SELF_RATE", "RED"),
    }
    cards = spark.createDataFrame(
        [(D(2026, 1, 1), "x", 10.0, 9.0, 1), (D(2026, 1, 4), "x", 10.0, 9.4, 0), (D(2026, 1, 5), "x", 10.0, 9.9, 0), (D(2026, 1, 5), "q", 1.0, 1.0, 0)],
        "dt date, sku_id string, platform_price double, supply_price double, is_up_today int",
    )
    swings = trial.price_swings(cards, ["x"], trial.TrialRules()).orderBy("dt").collect()
    assert [(r["implied_rate"], r["swing"], r["status"], r["is_new_listing"]) for r in swings] == [
        (0.1, None, "OK", 1), (0.06, 0.044444, "OK", 0), (0.01, 0.053191, "YELLOW", 0)]
