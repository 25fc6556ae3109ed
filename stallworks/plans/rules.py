"""Business literals of the reports, all of them parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

#: Enum labels of complaint tickets.
APPLY_TYPES = {"OOS": "缺货", "AFTER_SALE": "售后", "AFTER_SALE_AGAIN": "申述"}
COMPLAINT_TYPES = {
    "BE_SHORT_OF_WEIGHT": "缺斤少两",
    "QUALITY_ISSUES": "品质问题",
    "APPEARANCE_PROBLEM": "品相问题",
    "CARGO_WRONG_EDITION": "货不对版",
    "FRESHNESS_PROBLEM": "鲜度问题",
    "MATURITY_PROBLEM": "熟度问题",
    "SHORTAGE": "缺货",
    "LOGISTIC_PROBLEM": "物流问题",
    "PURCHASE_AGREE_PAY_CHANNEL": "免赔",
    "TASTE_PROBLEMS": "口感问题",
    "INSPECTION_REJECTION": "现场拒收",
    "OTHERS_MILK": "奶品问题",
}
#: The columns that identify a row of each detail route.
ROW_KEYS = {
    "after_sale_detail": ("ticket_id",),
    "order_detail": ("order_item_id",),
    "store_stat_detail": ("store_id", "dt"),
    "store_cat1_stat_detail": ("store_id", "cat1", "dt"),
    "cat4_stat_detail": ("cat1", "cat4", "dt"),
    "mct_cat4_stat_detail": ("merchant_id", "cat1", "cat4", "dt"),
    "sku_stat_detail": ("merchant_id", "cat1", "cat4", "sku_id", "dt"),
}


@dataclass(frozen=True)
class Rules:
    """Category lists, thresholds and labels. Defaults are the usual configuration."""

    #: Fixed values, down to ``missing_rep``: names and labels that stored tables carry.
    special_cat4: Sequence[str] = ("金枕榴莲", "干尧榴莲", "甲仑榴莲", "托曼尼榴莲", "青尼榴莲")
    special_label: str = "榴莲"
    pilot_cat4: Sequence[str] = ("麒麟西瓜", "香蕉")
    vegetable_cat1: Sequence[str] = ("蔬菜", "干货")
    fruit_cat1: str = "水果"
    quality_types: Sequence[str] = ("成熟度", "腐坏变质", "鲜度问题")
    flow_page: str = "买过页"
    trial_counties: Sequence[str] = ("望城", "长沙", "芙蓉")
    trial_grid_tag: str = "KA网格"
    treatment_label: str = "试验区域试验组"
    control_label: str = "试验区域对照组"
    agent_label: str = "代理人区域"
    direct_label: str = "直营区域"
    online_tag: str = "线上"
    online_rep: tuple[int, str] = (-88, "线上运营")
    missing_rep: tuple[int, str] = (-99, "其他/未配置")
    #: Thresholds of the reports.
    sku_target_share: float = 0.1
    special_penetration: float = 0.10
    top_rank: int = 3
    #: Penetration buckets: name -> (from, below); None is open.
    penetration_bins: tuple[tuple[str, float, float | None], ...] = (
        ("cat4_penetration_ge35", 0.35, None),
        ("cat4_penetration_25_35", 0.25, 0.35),
        ("cat4_penetration_15_25", 0.15, 0.25),
        ("cat4_penetration_05_15", 0.05, 0.15),
    )
    low_penetration: float = 0.05
    high_penetration: float = 0.15


def row_key_columns(route: str) -> list[str]:
    """Key columns of a detail route."""
    if route not in ROW_KEYS:
        raise ValueError(f"no row key is defined for route {route!r}")
    return list(ROW_KEYS[route])
