"""The reports' columns, by name: what a reader of the reference's output expects."""

import pytest

from stallworks.catalog import REGISTRY, roles

SF_DIR = "/root/testdata/sf0.001"
PLACE = "province_id province_name city_id city_name county_id county_name"
MEASURES = (
    "exposed_cnt ordered_amt delivered_amt delivered_num after_sale_num_quality after_sale_num refund_quality refund_amt "
    "natural_refund_amt commission_amt"
).split()
STORE_STAT = ["store_id", "dt", *MEASURES, *[f"{m}_{b}" for b in ("d30", "d14", "d7") for m in MEASURES]]
STORE_STAT += [f"{a}_{b}" for b in ("d30", "p7", "d7") for a in ("exposed_days", "ordered_days")]

COLUMNS = {
    "q04": (
        "dt dt_month is_last_day mall cat1 cat2 cat3 cat4_id cat4 delivered_amt refund_amt sku_num_onsale sku_num_sold exposed_store_num_old "
        "ordered_store_num_old penetration order_cnt target_sku_num delivered_amt_rank penetration_rank onshelf_sku_num updated_sku_num"
    ).split(),
    "q06": (
        f"dt mall_id mall grid_id grid_name operate_type bd_id bd_name store_id {PLACE} cat1_id cat1 cat4_id cat4 is_vegetable is_trial trial_group "
        "is_pilot special_label delivered_amt refund_amt ordered_num commission_amt is_after_sale is_rebuy upgrade_refund upgrade_platform_refund"
    ).split(),
    "q07": (
        "apply_day ticket_id ticket_no refund_no apply_type order_id order_no order_item_id order_item_no sku_id sku_code sku_name defective_rate "
        f"back_category_id back_category sku_grade producing_area packaging merchant_name store_id {PLACE} track_files expected_amt bad_weight bad_num "
        "problems images videos handler_id handler_name complaint_type remark problem_remark handle_remark service_remark final_amt status real_status "
        "arrival_time apply_time claim_time handle_time handle_duration mall_id operate_type"
    ).split(),
    "q08": (
        "dt order_item_id order_item_no order_id order_no sku_id sku_name merchant_name back_category_id back_category sku_grade producing_area packaging "
        f"store_id {PLACE} grid_id grid_name ordered_num ordered_amt delivered_amt delivered_num payment_amt mall_id operate_type"
    ).split(),
    "q09": STORE_STAT,
    "q11": (
        "dt store_id cat1_id cat1 ordered_num ordered_amt delivered_num delivered_amt payment_amt refund_amt refund_quality commission_amt natural_refund_amt"
    ).split(),
    "q14": (
        "dt mall_id sku_id sku_code sku_name sku_grade producing_area packaging single_size color_code sku_quantity merchant_id merchant_name merchant_type "
        "back_category_id back_category net_weight gross_weight unit_price standard_price commission_rate supply_unit_price supply_standard_price is_up_today "
        "in_trial_period is_trial_sku"
    ).split(),
    "q15": (
        f"dt region_id region_name clean_name region_alias address_id address_name street_id street_name {PLACE} longitude latitude parent_id is_valid "
        "level level_name operate_type"
    ).split(),
}
COUNTS = {"q04": 22, "q06": 32, "q07": 50, "q08": 29, "q09": 48, "q11": 13, "q14": 26, "q15": 22}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert sorted(REGISTRY[name].run(spark, SF_DIR).columns) == sorted(COLUMNS[name])
    assert len(COLUMNS[name]) == COUNTS[name]


def test_the_feed_has_stores_that_only_saw_and_none_that_only_received(spark):
    r = roles.Roles(spark, SF_DIR)
    feed, found = r.store_feed, REGISTRY["q06"].run(spark, SF_DIR)
    keys = ["dt", "store_id", "cat1", "cat4"]
    seen = feed.where("exposed_num > 0 AND ordered_num = 0 AND after_sale_num = 0 AND delivered_amt = 0").select(*keys).distinct()
    received = feed.where("delivered_amt > 0 AND exposed_num + clicked_num + added_num + ordered_num + after_sale_num + rebuy_num = 0").select(*keys)
    assert seen.count() > 0 and seen.join(found, keys, "left_anti").count() == 0
    assert received.count() > 0 and received.join(found, keys).count() == 0


def test_a_refund_counts_once_on_each_calendar(spark):
    r = roles.Roles(spark, SF_DIR)
    for role in (r.visit_two_days, r.store_cat1):
        row = role.selectExpr("sum(refund_amt) AS a", "sum(natural_refund_amt) AS b", "count_if(refund_amt <> natural_refund_amt) AS n").first()
        assert row["a"] == row["b"] and row["n"] > 0


def test_nothing_is_written_or_run_while_a_shared_plan_is_built(spark, tmp_path, monkeypatch):
    roles.release_items()
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.parquet", lambda *a, **k: pytest.fail("a plan was written"))
    first = REGISTRY["q03"].run(spark, SF_DIR)
    held = dict(roles._SHARED)
    REGISTRY["q04"].run(spark, SF_DIR)
    assert len(held) == 1 and {k: id(v) for k, v in roles._SHARED.items()} == {k: id(v) for k, v in held.items()}
    assert "InMemoryTableScan" in first._jdf.queryExecution().executedPlan().toString()
    roles.release_items()
    assert not roles._SHARED


def test_shared_items_are_added_up_where_they_lie(spark):
    roles.release_items()
    held = roles.Roles(spark, SF_DIR).stored()
    for role in (held.mall_cat4, held.mall_cat1, held.sku_mall, held.complaint, held.store_cat4, held.goods_day):
        role.collect()
        final = role._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        above = final.split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in above and "Exchange" not in above
    roles.release_items()
