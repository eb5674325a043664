"""The six target tables. Names are defaults: `spec.named("db.table")` points a job elsewhere."""

from __future__ import annotations

from pyspark.sql import types as T

from dayledger.sinks.tables import TableSpec, column

BIGINT, STRING, TIMESTAMP, BOOLEAN = (
    T.LongType(), T.StringType(), T.TimestampType(), T.BooleanType())


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([column(*f) for f in fields])


APPLY_COUNT = TableSpec("apply_count", _schema(
    ("org_id", BIGINT, "organisation"),
    ("level1_node_name", STRING, "store, first level"),
    ("level2_node_name", STRING, "store, second level"),
    ("brandgood_name", STRING, "model name"),
    ("bg_apply_dcnt", BIGINT, "distinct designs that use the model"),
), "Designs per organisation, store and model")

ACCOUNT_MATERIAL_COLUMNS = (
    ("brandgood_id", BIGINT, "material"),
    ("brandgood_name", STRING, "material name"),
    ("brandgood_pic", STRING, "material picture"),
    ("brandgood_created", TIMESTAMP, "material created"),
    ("brandgood_lastmodified", TIMESTAMP, "material last modified"),
    ("visible", BOOLEAN, "shown in the tool"),
    ("cat_id", BIGINT, "category"),
    ("account_id", BIGINT, "account"),
    ("root_account_id", BIGINT, "root account"),
    ("account_name", STRING, "account name"),
    ("account_fullname", STRING, "customer name in full"),
    ("cat_name", STRING, "category name"),
    ("cat1_name", STRING, "category name, level 1"),
    ("cat2_name", STRING, "category name, level 2"),
    ("cat3_name", STRING, "category name, level 3"),
    ("cat4_name", STRING, "category name, level 4"),
    ("cat5_name", STRING, "category name, level 5"),
    ("is_test_cate", BOOLEAN, "test category"),
    ("vc_itemset", STRING, "model library"),
    ("vc_itemset_tab", STRING, "tab of the model library"),
    ("vc_itemset_type_chs", STRING, "type of the model library"),
    ("public_type", STRING, "public or private"),
)

APPLY_DETAIL = TableSpec("account_apply_detail", _schema(
    *ACCOUNT_MATERIAL_COLUMNS,
    ("design_id", BIGINT, "design"),
    ("design_created", TIMESTAMP, "design created"),
    ("design_lastmodified", TIMESTAMP, "design last modified"),
    ("design_community_name", STRING, "community of the design"),
    ("design_community_province_name", STRING, "province of that community"),
    ("design_community_city_name", STRING, "city of that community"),
    ("design_user_id", BIGINT, "designer"),
    ("design_user_name", STRING, "designer's name"),
    ("design_user_province_name", STRING, "designer's province"),
    ("design_user_city_name", STRING, "designer's city"),
    ("fpspec_devide_1", STRING, "room class of the design"),
    ("area_devide_1", STRING, "area class of the design"),
    ("relation_design_id", BIGINT, "design of the relation, -1 for none"),
), "Materials of listed accounts in the designs of the same account")

RENDER_FLAGS = TableSpec("render_flags", _schema(
    ("pic_id", BIGINT, "render image"),
    ("design_id", BIGINT, "design of the image"),
    ("camera_type_id", BIGINT, "camera type, -1 for none"),
    ("camera_type_name", STRING, "camera type name"),
    ("account_id", BIGINT, "account"),
    ("org_id", BIGINT, "organisation"),
    ("user_id", BIGINT, "owner"),
    ("org_user_type", BIGINT, "kind of account"),
    ("1d_is_created", BOOLEAN, "created on the day"),
    ("1d_is_deleted", BOOLEAN, "deleted on the day"),
    ("1m_is_created", BOOLEAN, "created in the month"),
    ("1m_is_deleted", BOOLEAN, "deleted in the month"),
    ("deleted", BOOLEAN, "deleted by now"),
), "Render images with created and deleted flags", retention_days=7)

ORDER_MATERIAL = TableSpec("order_material", _schema(
    ("org_id", BIGINT, "organisation"),
    ("order_readable_id", STRING, "order id for people"),
    ("design_id", BIGINT, "design"),
    ("value", STRING, "audit number"),
    ("created", TIMESTAMP, "first submission"),
    ("review_status", STRING, "review state"),
    ("last_modified", TIMESTAMP, "state last changed"),
    ("brandgood_id", BIGINT, "material"),
    ("dhd_type", STRING, "kind of material: furniture, material, molding, customized, decoration"),
    ("b4110_1_design_brandgood_relation_cnt", BIGINT, "uses of the material in the design"),
    ("brandgood_name", STRING, "material name"),
), "Materials of submitted designs")

REWARD_LOG = TableSpec("reward_log", _schema(
    ("id", BIGINT, "key"),
    ("task_id", BIGINT, "task"),
    ("user_id", BIGINT, "user"),
    ("received", BIGINT, "1 once the reward is out, else 0"),
    ("user_task_id", BIGINT, "progress record"),
    ("turn", BIGINT, "round of a repeated task, from 0"),
    ("attach", STRING, "extra information"),
    ("deleted", BOOLEAN),
    ("created", TIMESTAMP),
    ("lastmodified", TIMESTAMP),
    ("reward_snapshot", STRING, "reward at the time"),
    ("receive_detail", STRING, "how it was received"),
), "Rewards of user tasks")

RELATION_TAGS = TableSpec("relation_tags", _schema(
    ("design_id", BIGINT, "design"),
    ("brandgood_id", BIGINT, "material"),
    ("itemset_type", BIGINT, "1 model, 2 customized, 3 decoration, 0 other"),
    ("user_id", BIGINT, "designer"),
    ("province", BIGINT, "designer's province"),
    ("province_name", STRING, "its name"),
    ("city", BIGINT, "designer's city"),
    ("city_name", STRING, "its name"),
    ("account_id", BIGINT, "account"),
    ("org_user_type", BIGINT, "kind of account"),
    ("org_id", BIGINT, "organisation"),
    ("fpspec_devide_1", STRING, "room class"),
    ("area_devide_1", STRING, "area class"),
    ("deleted", BOOLEAN, "design deleted"),
    ("prodcat1_id", BIGINT, "material category, level 1"),
    ("prodcat1_name", STRING, "its name"),
    ("prodcat2_id", BIGINT, "material category, level 2"),
    ("prodcat2_name", STRING, "its name"),
    ("prodcat3_id", BIGINT, "material category, level 3"),
    ("prodcat3_name", STRING, "its name"),
    ("1d_is_created", BOOLEAN, "not there yesterday"),
    ("1m_is_created", BOOLEAN, "not there at the end of last month"),
    ("item_type", BIGINT, "material type"),
    ("usable_bg_source", STRING, "where the right to use the material comes from"),
    ("src_org_id", BIGINT, "organisation that grants it"),
    ("deco_cat1_id", BIGINT, "decoration category, level 1"),
    ("deco_cat1_name", STRING, "its name"),
    ("deco_cat2_id", BIGINT, "decoration category, level 2"),
    ("deco_cat2_name", STRING, "its name"),
), "Design and material relations with user, category and usage tags")
