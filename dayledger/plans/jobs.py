"""The jobs by name, and how to run one into its table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark.sql import DataFrame

from dayledger.plans import order_material as om
from dayledger.plans import schemas
from dayledger.plans.apply_count import daily_apply_count, monthly_apply_count
from dayledger.plans.apply_detail import account_apply_detail, account_apply_detail_plain
from dayledger.plans.relation_tags import relation_tags
from dayledger.plans.render_flags import render_flags
from dayledger.plans.reward_merge import reward_merge
from dayledger.rundate import RunDate
from dayledger.settings import apply_settings, require_time_zone
from dayledger.sinks import TableSpec, append_partition, drop_expired, drop_expired_path, ensure_table, staged, write_partition
from dayledger.sources import Catalog


@dataclass(frozen=True)
class Job:
    """How to build a job and lay out its table. With `staged` its core is written out first,
    because it is read several times, and the build gets those options. A table in buckets is its own
    source, and the build gets their number."""

    build: Callable[..., DataFrame]
    spec: TableSpec
    cluster_by: tuple[str, ...] | None = None
    staged: Mapping[str, Any] | None = None


def _order_material(build: Callable[..., DataFrame], staged: Mapping[str, Any] | None = None) -> Job:
    return Job(build, schemas.ORDER_MATERIAL, cluster_by=("design_id",), staged=staged)


JOBS: dict[str, Job] = {
    "monthly_apply_count": Job(monthly_apply_count, schemas.APPLY_COUNT),
    "daily_apply_count": Job(daily_apply_count, schemas.APPLY_COUNT),
    "account_apply_detail": Job(account_apply_detail, schemas.APPLY_DETAIL, cluster_by=()),
    "account_apply_detail_plain": Job(account_apply_detail_plain, schemas.APPLY_DETAIL, cluster_by=()),
    "render_flags": Job(render_flags, schemas.RENDER_FLAGS),
    "order_material_detail": Job(om.order_material_detail, schemas.ORDER_MATERIAL),
    "order_material_onepass": _order_material(om.order_material_onepass, {}),
    "order_material_fallback": _order_material(om.order_material_fallback, {}),
    "order_material_three_level": _order_material(om.order_material_three_level, {}),
    "order_material_defaults": _order_material(om.order_material_defaults),
    "order_material_nulls": _order_material(om.order_material_nulls),
    "order_material_detail_source": _order_material(om.order_material_detail_source),
    "order_material_staged": _order_material(om.order_material_staged, {}),
    "order_material_staged_nulls": _order_material(om.order_material_staged, {"materials": False}),
    "reward_merge": Job(reward_merge, schemas.REWARD_LOG),
    "reward_merge_bucketed": Job(reward_merge, schemas.REWARD_LOG.bucketed(["id"], 512)),
    "relation_tags": Job(relation_tags, schemas.RELATION_TAGS),
}


def run_job(
    name: str,
    catalog: Catalog,
    run: RunDate,
    spec: TableSpec | None = None,
    path: str | None = None,
    append: bool = False,
    expire: bool = False,
    token: str | None = None,
) -> None:
    """Build one day of a job and write it: to the table of `spec`, made if absent, or under
    `path`. `append` adds to the day instead of replacing it, with a `token` that names the run where
    days are made of runs; `expire` then drops the days past the table's retention, there or under the path. The session gets the recommended settings, and must have a time zone."""
    require_time_zone(catalog.spark)
    apply_settings(catalog.spark)
    job = JOBS[name]
    spec = spec or job.spec
    if path is None:
        ensure_table(catalog.spark, spec)
    write = partial(append_partition, token=token) if append else write_partition
    if spec.buckets and not append:
        rows = job.build(catalog, run, buckets=spec.buckets)
        write_partition(rows, spec, run.ds, path, in_buckets=True)
    elif job.staged is None:
        write(job.build(catalog, run), spec, run.ds, path, job.cluster_by)
    else:
        with staged(om.order_core(catalog, run), f"{name}-core") as core:
            write(job.build(catalog, run, core=core, **job.staged), spec, run.ds, path, job.cluster_by)
    if expire and path is None:
        drop_expired(catalog.spark, spec.name, run, spec.retention_days)
    elif expire:
        drop_expired_path(catalog.spark, path, run, spec.retention_days)
