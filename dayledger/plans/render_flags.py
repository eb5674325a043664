"""Render images of organisation users, with created and deleted flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import eq, flag, label, period_flags, remap
from dayledger.operators import BROADCAST_LIMIT, checked_broadcast, mark, seen_on
from dayledger.plans.schemas import RENDER_FLAGS
from dayledger.rundate import RunDate
from dayledger.sources import Catalog, snapshot

# The owner id that stands for a deleted image, and the camera labels.
DELETED_OWNER = 1
CAMERA = {1: "普通图", 2: "全景图", 3: "俯视图"}
OTHER_CAMERA = "其它"


def render_flags(
    catalog: Catalog, run: RunDate, dedup: bool = True, max_bytes: int = BROADCAST_LIMIT
) -> DataFrame:
    """Original images only. An image is deleted by its flag or by its owner, in which case the
    author counts as owner. It was deleted today (this month) if it was not yet deleted in
    yesterday's (last month end's) snapshot. `dedup=False` repeats an image for every copy of it
    among those."""
    originals = catalog.table("render").where(F.col("from_pid").isNull())
    is_deleted = eq("deleted", True) | eq("user_id", DELETED_OWNER)
    today, this_month = period_flags("created", run)
    current = snapshot(originals, run.ds).select(
        "pic_id",
        "design_id",
        F.coalesce("camera_type_id", F.lit(-1)).alias("camera_type_id"),
        label("camera_type_id", CAMERA, OTHER_CAMERA).alias("camera_type_name"),
        remap("user_id", DELETED_OWNER, F.col("author_id")).alias("user_id"),
        flag(is_deleted).alias("deleted"),
        today.alias("1d_is_created"),
        this_month.alias("1m_is_created"),
    )
    org_users = snapshot(catalog.table("org_user"), run.ds).select(
        "account_id", "org_id", "user_id", "org_user_type")
    owned = current.join(checked_broadcast(org_users, max_bytes), "user_id")

    gone = originals.where(is_deleted).select("pic_id", "ds")
    before = {"gone_yesterday": run.prev_day, "gone_last_month": run.prev_month_end}
    if dedup:
        compared = owned.join(seen_on(gone, ["pic_id"], before), "pic_id", "left")
    else:
        compared = owned
        for name, ds in before.items():
            compared = mark(compared, snapshot(gone, ds), ["pic_id"], name, dedup=False)
    return compared.withColumns({
        "1d_is_deleted": F.col("deleted") & ~flag(F.col("gone_yesterday")),
        "1m_is_deleted": F.col("deleted") & ~flag(F.col("gone_last_month")),
    }).select(*[f"`{name}`" for name in RENDER_FLAGS.schema.names])
