"""The daily report that fuses mall KPIs, quality rejects and pilot categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ...functions.values import is_one_of, nz, ratio, to_number
from ...operators.joins import harmonised
from ...operators.metrics import Metrics, aggregate, group_counts
from ...operators.reshape import drop_internal, unpivot_flags
from ...operators.rolling import repeat_entities
from ..rules import Rules


def quality_rejects(df: DataFrame, by: Sequence[str] = ("dt",), entity: str = "goods_id") -> DataFrame:
    """Rejects and distinct goods per group; per day also goods rejected on several days of 7."""
    counts = group_counts(df, by, entity).withColumnsRenamed(
        {"n_rows": "n_rejects", "n_distinct": "n_reject_goods"}
    )
    if list(by) != ["dt"]:
        return counts
    repeats = repeat_entities(df, "dt", entity, span=7, out="n_repeat_7d")
    return counts.join(repeats, "dt", "left").withColumn("n_repeat_7d", nz("n_repeat_7d"))


def dedup_rejects(df: DataFrame) -> DataFrame:
    """One reject per day and goods, whatever was entered twice."""
    return df.select("dt", "goods_id").distinct()


def pilot_kpis(detail: DataFrame, flags: DataFrame, pilots: dict[str, str], rules: Rules) -> DataFrame:
    """KPIs per day from the store × category feed and the wide pilot flags.

    19 conditional sums and distinct counts from one two-level aggregate, then four
    commission rates.
    """
    marks = unpivot_flags(flags, ["dt", "store_id"], pilots, "cat4", "pilot_mark")
    marks = marks.withColumn("store_id", harmonised("store_id"))
    stored = detail.schema["store_id"].dataType
    if isinstance(stored, T.IntegralType):
        # the mark's text becomes the number that reads the same, so the detail stays where it lies by store
        number = F.col("store_id").try_cast(stored)
        marks = marks.withColumn("store_id", F.when(number.cast("string") == F.col("store_id"), number))
    else:
        detail = detail.withColumn("store_id", harmonised("store_id"))
    numbers = ("delivered_amt", "ordered_num", "commission_amt")
    rows = (
        detail
        # ten digits behind the point hold every amount; NaN and infinities count as none
        .withColumns({c: nz(F.col(c).try_cast("decimal(32,10)")) for c in numbers})
        .withColumns({c: to_number(c, 0.0) for c in ("is_pilot", "is_after_sale", "is_rebuy")})
        .join(marks, ["dt", "store_id", "cat4"], "left")
        .withColumn("pilot_mark", nz("pilot_mark"))
    )
    direct = F.col("operate_type") == rules.direct_label
    agent = F.col("operate_type") == rules.agent_label
    special = F.col("special_label") == rules.special_label
    plain = ~F.coalesce(special, F.lit(False))
    fruit = F.col("cat1") == rules.fruit_cat1
    pilot, after_sale, rebuy = (F.col(c) == 1 for c in ("is_pilot", "is_after_sale", "is_rebuy"))
    delivered, commission = F.col("delivered_amt"), F.col("commission_amt")
    term = Metrics.when_sum
    sums: dict[str, Column] = {
        "delivered_direct": term(direct, delivered),
        "delivered_agent": term(agent, delivered),
        "delivered_treatment": term(F.col("trial_group") == rules.treatment_label, delivered),
        "delivered_control": term(F.col("trial_group") == rules.control_label, delivered),
        "ordered_agent_special": term(agent & special, F.col("ordered_num")),
        "pilot_stores": F.col("pilot_mark"),
    }
    for side, cond in (("direct", direct), ("agent", agent)):
        sums[f"fruit_commission_{side}"] = term(fruit & cond, commission)
        sums[f"fruit_delivered_{side}"] = term(fruit & cond, delivered)
        sums[f"fruit_commission_{side}_ex"] = term(fruit & cond & plain, commission)
        sums[f"fruit_delivered_{side}_ex"] = term(fruit & cond & plain, delivered)
    distincts = {
        "vegetable_direct_stores": is_one_of("cat1", rules.vegetable_cat1) & direct,
        "special_stores": special & (F.col("ordered_num") > 0),
        "pilot_after_sale_stores": pilot & after_sale,
        "pilot_rebuy_stores": pilot & after_sale & rebuy,
        "pilot_mark_rebuy_stores": (F.col("pilot_mark") == 1) & rebuy,
    }
    stat = aggregate(
        rows, ["dt"], Metrics(sums=sums, distincts={n: ("store_id", c) for n, c in distincts.items()})
    )
    rates = {
        f"fruit_rate_{side}": ratio(f"fruit_commission_{side}", f"fruit_delivered_{side}", None)
        for side in ("direct", "agent", "direct_ex", "agent_ex")
    }
    return stat.withColumns(rates)


def okr_report(
    mall_stat: DataFrame,
    rejects: DataFrame,
    detail: DataFrame,
    flags: DataFrame,
    pilots: dict[str, str],
    rules: Rules,
) -> DataFrame:
    """Mall KPIs left-joined by day with reject statistics and pilot KPIs."""
    quality = quality_rejects(dedup_rejects(rejects))
    pilot = pilot_kpis(detail, flags, pilots, rules)
    fused = mall_stat.join(quality, "dt", "left").join(pilot, "dt", "left")
    return drop_internal(fused)
