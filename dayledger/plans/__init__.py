from dayledger.plans.apply_count import daily_apply_count, monthly_apply_count
from dayledger.plans.apply_detail import account_apply_detail, account_apply_detail_plain
from dayledger.plans.jobs import JOBS, run_job
from dayledger.plans.order_material import (
    order_core,
    order_material_defaults,
    order_material_detail,
    order_material_detail_source,
    order_material_fallback,
    order_material_nulls,
    order_material_onepass,
    order_material_sketches,
    order_material_staged,
    order_material_three_level,
)
from dayledger.plans.relation_tags import relation_tags
from dayledger.plans.render_flags import render_flags
from dayledger.plans.reward_merge import reward_merge

__all__ = [
    "JOBS", "account_apply_detail", "account_apply_detail_plain", "daily_apply_count",
    "monthly_apply_count", "order_core", "order_material_defaults", "order_material_detail",
    "order_material_detail_source", "order_material_fallback", "order_material_nulls",
    "order_material_onepass", "order_material_sketches", "order_material_staged",
    "order_material_three_level",
    "relation_tags", "render_flags", "reward_merge", "run_job",
]
