"""The jobs on the test tables."""

from uuid import uuid4

from checks import roles
from checks.registry import RUN, Tables, query
from dayledger import plans
from dayledger.plans.schemas import REWARD_LOG
from dayledger.sinks import ensure_table, stage, write_partition
from dayledger.sinks.staging import fresh_path
from dayledger.sources import Catalog, snapshot


@query(roles.APPLY_COUNT_SQL + "SELECT * FROM apply_count")
def job_monthly_apply_count(t: Tables):
    return plans.monthly_apply_count(roles.apply_count(t), RUN)


@query(roles.APPLY_COUNT_DAILY_SQL + "SELECT * FROM apply_count")
def job_daily_apply_count(t: Tables):
    return plans.daily_apply_count(roles.apply_count(t, daily=True), RUN)


@query(roles.APPLY_DETAIL_SQL + "SELECT * FROM account_apply_detail")
def job_account_apply_detail(t: Tables):
    return plans.account_apply_detail(roles.apply_detail(t), RUN)


@query(roles.APPLY_DETAIL_SQL + "SELECT * FROM account_apply_detail")
def job_account_apply_detail_plain(t: Tables):
    return plans.account_apply_detail_plain(roles.apply_detail(t), RUN)


@query(roles.RENDER_SQL + "SELECT * FROM render_flags")
def job_render_flags(t: Tables):
    return plans.render_flags(roles.renders(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_detail")
def job_order_material_detail(t: Tables):
    return plans.order_material_detail(roles.order_material(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_onepass")
def job_order_material_onepass(t: Tables):
    return plans.order_material_onepass(roles.order_material(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_fallback")
def job_order_material_fallback(t: Tables):
    return plans.order_material_fallback(roles.order_material(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_three_level")
def job_order_material_three_level(t: Tables):
    return plans.order_material_three_level(roles.order_material(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_defaults")
def job_order_material_defaults(t: Tables):
    return plans.order_material_defaults(roles.order_material(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_nulls")
def job_order_material_nulls(t: Tables):
    return plans.order_material_nulls(roles.order_material(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_detail_source")
def job_order_material_detail_source(t: Tables):
    return plans.order_material_detail_source(roles.order_material(t), RUN)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_onepass")
def job_order_material_staged(t: Tables):
    catalog = roles.order_material(t)
    core = stage(plans.order_core(catalog, RUN), "core")
    return plans.order_material_staged(catalog, RUN, core)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_nulls")
def job_order_material_staged_nulls(t: Tables):
    catalog = roles.order_material(t)
    core = stage(plans.order_core(catalog, RUN), "core")
    return plans.order_material_staged(catalog, RUN, core, materials=False)


@query(roles.REWARD_SQL + "SELECT * FROM reward_merge")
def job_merge_increment(t: Tables):
    return plans.reward_merge(roles.rewards(t), RUN)


@query(roles.REWARD_SQL + "SELECT * FROM reward_merge")
def job_merge_bucketed(t: Tables):
    """The merge within a table in buckets: yesterday is read from it, today written to it, and no
    increment is small enough for a broadcast."""
    catalog = roles.rewards(t)
    spec = REWARD_LOG.named(f"reward_log_{uuid4().hex}").bucketed(["id"], 8)
    ensure_table(t.spark, spec, fresh_path(t.spark, "table"))
    write_partition(catalog.table("reward_snapshot"), spec, RUN.prev_day)
    own = Catalog(t.spark, {"reward_snapshot": spec.name, "reward_increment": catalog.table("reward_increment")})
    write_partition(plans.reward_merge(own, RUN, max_bytes=0, buckets=spec.buckets), spec, RUN.ds, in_buckets=True)
    return snapshot(t.spark.table(spec.name), RUN.ds).drop("ds")


@query(roles.RELATION_TAGS_SQL + "SELECT * FROM relation_tags")
def job_relation_tags(t: Tables):
    return plans.relation_tags(roles.relation_tags(t), RUN)


@query(roles.RELATION_TAGS_LITERAL_SQL + "SELECT * FROM relation_tags")
def job_relation_tags_literal(t: Tables):
    return plans.relation_tags(roles.relation_tags(t), RUN, dedup=False)


# The same jobs as they run where nothing fits a broadcast, and where history is cut by a staged core.


@query(roles.APPLY_COUNT_SQL + "SELECT * FROM apply_count")
def job_monthly_apply_count_shuffled(t: Tables):
    return plans.monthly_apply_count(roles.apply_count(t), RUN, max_bytes=0)


@query(roles.APPLY_COUNT_DAILY_SQL + "SELECT * FROM apply_count")
def job_daily_apply_count_shuffled(t: Tables):
    return plans.daily_apply_count(roles.apply_count(t, daily=True), RUN, max_bytes=0)


@query(roles.APPLY_DETAIL_SQL + "SELECT * FROM account_apply_detail")
def job_account_apply_detail_shuffled(t: Tables):
    return plans.account_apply_detail(roles.apply_detail(t), RUN, max_bytes=0)


@query(roles.APPLY_DETAIL_SQL + "SELECT * FROM account_apply_detail")
def job_account_apply_detail_plain_shuffled(t: Tables):
    return plans.account_apply_detail_plain(roles.apply_detail(t), RUN, max_bytes=0)


@query(roles.RENDER_SQL + "SELECT * FROM render_flags")
def job_render_flags_shuffled(t: Tables):
    return plans.render_flags(roles.renders(t), RUN, max_bytes=0)


@query(roles.REWARD_SQL + "SELECT * FROM reward_merge")
def job_merge_increment_shuffled(t: Tables):
    return plans.reward_merge(roles.rewards(t), RUN, max_bytes=0)


@query(roles.RELATION_TAGS_SQL + "SELECT * FROM relation_tags")
def job_relation_tags_shuffled(t: Tables):
    return plans.relation_tags(roles.relation_tags(t), RUN, max_bytes=0)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_detail")
def job_order_material_detail_shuffled(t: Tables):
    return plans.order_material_detail(roles.order_material(t), RUN, max_bytes=0)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_onepass")
def job_order_material_onepass_shuffled(t: Tables):
    return plans.order_material_onepass(roles.order_material(t), RUN, max_bytes=0)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_fallback")
def job_order_material_fallback_shuffled(t: Tables):
    return plans.order_material_fallback(roles.order_material(t), RUN, max_bytes=0)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_three_level")
def job_order_material_sketched(t: Tables):
    """The job where each day's key sketches were kept: its relations are not read for hot keys."""
    catalog = roles.order_material(t)
    kept = stage(plans.order_material_sketches(catalog, RUN, before=7), "sketches")
    own = Catalog(t.spark, catalog.tables, sketches=kept)
    return plans.order_material_three_level(own, RUN, max_bytes=0)


@query(roles.ORDER_MATERIAL_SQL + "SELECT * FROM order_material_three_level")
def job_order_material_three_level_shuffled(t: Tables):
    return plans.order_material_three_level(roles.order_material(t), RUN, max_bytes=0)
