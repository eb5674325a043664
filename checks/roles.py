"""The test tables in the roles the jobs read, as DataFrames and, on their own, as SQL.

Each `*_SQL` text starts a WITH clause that defines the roles and then the job's expected result
under the job's name. The run day is 1998-06-30.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.registry import RUN, Tables
from dayledger.sources import Catalog


def dated(df: DataFrame, ds: str = RUN.ds) -> DataFrame:
    return df.withColumn("ds", F.lit(ds))


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def when(cond: str | Column, value, other=None) -> Column:
    cond = F.expr(cond) if isinstance(cond, str) else cond
    out = F.when(cond, value)
    return out if other is None else out.otherwise(other)


# Apply counts. Every date is moved to June of its year, so that the run month is a full one; in
# the one-day variant every relation is added on its year's 30th of June.


def in_june(ts: str) -> Column:
    day = F.least(F.dayofmonth(ts), F.lit(30)).cast("string")
    return F.concat(F.date_format(ts, "yyyy"), F.lit("06"), F.lpad(day, 2, "0"))


def apply_count(t: Tables, daily: bool = False) -> Catalog:
    users = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    designs = t.orders.join(users, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("n_regionkey").cast("bigint").alias("org_id"),
        F.col("o_orderpriority").alias("level1_node_name"),
        F.col("c_mktsegment").alias("level2_node_name"),
        F.col("o_orderkey").alias("design_id"),
        F.expr("""CASE WHEN o_orderstatus = 'F' THEN 'copy' WHEN o_orderpriority = '5-LOW' THEN 'blank'
                  ELSE 'normal' END""").alias("design_type"),
        F.to_date(in_june("o_orderdate"), "yyyyMMdd").cast("timestamp_ntz").alias("design_created"),
    )
    accounts = users.select(
        F.col("c_custkey").alias("join_user_id"),
        F.col("n_regionkey").cast("bigint").alias("org_id"),
        (F.col("c_acctbal") <= 0).alias("deleted"),
    )
    ds = F.date_format("l_shipdate", "yyyy'0630'") if daily else in_june("l_shipdate")
    relation = t.lineitem.select(
        F.col("l_orderkey").alias("design_id"), F.col("l_partkey").alias("brandgood_id"),
        when("l_returnflag = 'A'", 1, 2).alias("action_type"), ds.alias("ds"))
    category = F.expr("""CASE p_type WHEN 'ECONOMY' THEN '家具' WHEN 'LARGE' THEN '照明' WHEN 'SMALL' THEN '厨卫'
                         WHEN 'STANDARD' THEN '硬装' WHEN 'PROMO' THEN '吊顶' ELSE p_type END""")
    materials = t.part.select(
        F.col("p_partkey").alias("brandgood_id"),
        F.col("p_name").alias("brandgood_name"),
        F.col("p_size").cast("bigint").alias("user_id"),
        when("p_brand = 'Brand#25'", "public", "private").alias("public_type"),
        category.alias("prodcat1_name"),
        F.expr("CASE WHEN p_size <= 15 THEN '门' WHEN p_size <= 35 THEN '墙面' ELSE '电气模块' END")
        .alias("prodcat2_name"),
        F.expr("""CASE p_brand WHEN 'Brand#1' THEN '背景墙' WHEN 'Brand#2' THEN '壁炉' WHEN 'Brand#3' THEN '护墙板'
                  ELSE p_brand END""").alias("prodcat3_name"),
    )
    return Catalog(t.spark, {
        "design_basic": dated(designs),
        "business_account": dated(accounts),
        "bridge_increment": relation,
        "material": dated(materials),
    })


def apply_count_sql(relation_day: str, relation_filter: str) -> str:
    june = "strftime({0}, '%Y') || '06' || lpad(CAST(least(day({0}), 30) AS VARCHAR), 2, '0')"
    return f"""WITH designs AS (
        SELECT o_orderkey AS design_id, n_regionkey AS org_id, o_orderpriority, c_mktsegment
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'
          AND left({june.format('o_orderdate')}, 6) = '199806'),
    live AS (SELECT c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
             WHERE c_acctbal > 0),
    relation AS (SELECT l_orderkey, l_partkey, {relation_day.format(june=june.format('l_shipdate'))} AS ds,
                        l_returnflag FROM lineitem),
    listed AS (
        SELECT * FROM part WHERE p_brand <> 'Brand#25' AND (
            p_type IN ('ECONOMY', 'LARGE', 'SMALL')
            OR p_type = 'STANDARD' AND p_size <= 15
            OR p_type = 'STANDARD' AND p_size BETWEEN 16 AND 35
               AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
            OR p_type = 'PROMO' AND p_size > 35)),
    apply_count AS (
        SELECT CAST(org_id AS BIGINT) AS org_id, o_orderpriority AS level1_node_name,
               c_mktsegment AS level2_node_name, p_name AS brandgood_name,
               count(DISTINCT design_id) AS bg_apply_dcnt
        FROM designs JOIN relation ON design_id = l_orderkey JOIN listed ON l_partkey = p_partkey
        JOIN live ON p_size = c_custkey AND org_id = n_regionkey
        WHERE {relation_filter} GROUP BY ALL)
    """


APPLY_COUNT_SQL = apply_count_sql("{june}", "ds BETWEEN '19980601' AND '19980630'")
APPLY_COUNT_DAILY_SQL = apply_count_sql(
    "strftime(l_shipdate, '%Y') || '0630'", "ds = '19980630' AND l_returnflag = 'A'")


# Account details. Nations and part sizes 3 and 7 are the two listed accounts.


def root_account(col: str) -> Column:
    return F.expr(f"CASE {col} WHEN 3 THEN 106940 WHEN 7 THEN 1126425 ELSE {col} END").cast("bigint")


def apply_detail(t: Tables) -> Catalog:
    size = F.col("p_size")
    materials = t.part.select(
        F.col("p_partkey").alias("brandgood_id"),
        F.col("p_name").alias("brandgood_name"),
        F.concat(F.col("p_name"), F.lit(".png")).alias("brandgood_pic"),
        F.lit("1998-01-01").cast("timestamp_ntz").alias("brandgood_created"),
        F.date_add(F.lit("1998-01-01").cast("date"), size).cast("timestamp_ntz")
        .alias("brandgood_lastmodified"),
        (size > 3).alias("visible"),
        (size + 100).cast("bigint").alias("cat_id"),
        size.cast("bigint").alias("account_id"),
        root_account("p_size").alias("root_account_id"),
        F.col("p_brand").alias("account_name"),
        F.concat("p_brand", F.lit(" "), "p_type").alias("account_fullname"),
        F.col("p_type").alias("cat_name"),
        *[F.concat("p_type", F.lit(f"-{n}")).alias(f"cat{n}_name") for n in (1, 2, 3, 4, 5)],
        (F.col("p_type") == "SMALL").alias("is_test_cate"),
        F.col("p_brand").alias("vc_itemset"),
        F.col("p_type").alias("vc_itemset_tab"),
        F.col("p_type").alias("vc_itemset_type_chs"),
        F.lit("private").alias("public_type"),
    )
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    designs = t.orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("design_id"),
        F.col("o_custkey").alias("user_id"),
        root_account("c_nationkey").alias("root_account_id"),
        F.col("o_orderdate").alias("created"),
        F.date_add("o_orderdate", 1).cast("timestamp_ntz").alias("lastmodified"),
        F.col("o_orderpriority").alias("community_name"),
        F.nullif((F.col("o_custkey") % 30), F.lit(4)).alias("comm_logic_area_id"),
        F.col("n_regionkey").cast("bigint").alias("comm_logic_province_id"),
        F.col("c_name").alias("user_name"),
        F.col("r_name").alias("province_name"),
        F.col("n_name").alias("city_name"),
        F.col("c_mktsegment").alias("fpspec_devide_1"),
        F.col("o_orderstatus").alias("area_devide_1"),
        (F.col("o_orderstatus") == "F").alias("deleted"),
    )
    relation = t.lineitem.select(
        F.col("l_orderkey").alias("design_id"), F.col("l_partkey").alias("brandgood_id"))
    area = t.nation.select(F.col("n_nationkey").cast("bigint").alias("area_id"), F.col("n_name").alias("name"))
    return Catalog(t.spark, {
        "account_material": dated(materials),
        "design": dated(designs),
        "bridge": dated(relation),
        "area": dated(area),
    })


APPLY_DETAIL_SQL = """WITH pairs AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
    account_apply_detail AS (
        SELECT p_partkey AS brandgood_id, p_name AS brandgood_name, p_name || '.png' AS brandgood_pic,
               TIMESTAMP '1998-01-01' AS brandgood_created,
               TIMESTAMP '1998-01-01' + p_size * INTERVAL 1 DAY AS brandgood_lastmodified,
               p_size > 3 AS visible, CAST(p_size + 100 AS BIGINT) AS cat_id, CAST(p_size AS BIGINT) AS account_id,
               CAST(CASE p_size WHEN 3 THEN 106940 ELSE 1126425 END AS BIGINT) AS root_account_id,
               p_brand AS account_name, p_brand || ' ' || p_type AS account_fullname, p_type AS cat_name,
               p_type || '-1' AS cat1_name, p_type || '-2' AS cat2_name, p_type || '-3' AS cat3_name,
               p_type || '-4' AS cat4_name, p_type || '-5' AS cat5_name, p_type = 'SMALL' AS is_test_cate,
               p_brand AS vc_itemset, p_type AS vc_itemset_tab, p_type AS vc_itemset_type_chs,
               'private' AS public_type,
               o_orderkey AS design_id, o_orderdate AS design_created,
               o_orderdate + INTERVAL 1 DAY AS design_lastmodified,
               o_orderpriority AS design_community_name, prov.n_name AS design_community_province_name,
               city.n_name AS design_community_city_name, o_custkey AS design_user_id, c_name AS design_user_name,
               r_name AS design_user_province_name, own.n_name AS design_user_city_name,
               c_mktsegment AS fpspec_devide_1, o_orderstatus AS area_devide_1, l_orderkey AS relation_design_id
        FROM pairs JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation own ON c_nationkey = own.n_nationkey
        JOIN region ON own.n_regionkey = r_regionkey
        LEFT JOIN nation city ON city.n_nationkey = nullif(o_custkey % 30, 4)
        LEFT JOIN nation prov ON prov.n_nationkey = own.n_regionkey
        WHERE o_orderstatus <> 'F' AND p_size = c_nationkey AND p_size IN (3, 7))
    """


# Render images: orders, as they were on the run day, the day before and the last month's end.


def renders(t: Tables) -> Catalog:
    images = t.orders.select(
        F.col("o_orderkey").alias("pic_id"),
        (F.col("o_orderkey") + 1000).alias("design_id"),
        F.expr("CAST(nullif(left(o_orderpriority, 1), '4') AS BIGINT)").alias("camera_type_id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderkey") % 100).alias("author_id"),
        when("o_orderpriority = '5-LOW'", F.col("o_orderkey")).alias("from_pid"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END").alias("deleted"),
        F.col("o_orderdate").alias("created"),
    )
    as_of = [
        dated(images.where(F.col("created") <= F.to_date(F.lit(ds), "yyyyMMdd")), ds)
        for ds in (RUN.ds, RUN.prev_day, RUN.prev_month_end)
    ]
    return Catalog(t.spark, {"render": union(*as_of), "org_user": dated(org_users(t))})


def org_users(t: Tables) -> DataFrame:
    return t.customer.select(
        (F.col("c_custkey") + 1000).alias("account_id"),
        F.col("c_nationkey").cast("bigint").alias("org_id"),
        F.col("c_custkey").alias("user_id"),
        when("c_mktsegment = 'BUILDING'", 2, 1).cast("bigint").alias("org_user_type"),
    )


ORG_USERS = """org_users AS (
        SELECT c_custkey + 1000 AS account_id, CAST(c_nationkey AS BIGINT) AS org_id, c_custkey AS user_id,
               CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 2 ELSE 1 END AS BIGINT) AS org_user_type
        FROM customer)"""

RENDER_SQL = f"""WITH {ORG_USERS}, images AS (
        SELECT *, coalesce(o_orderstatus = 'F' OR o_custkey = 1, false) AS gone,
               CASE o_custkey WHEN 1 THEN o_orderkey % 100 ELSE o_custkey END AS owner,
               CAST(left(o_orderpriority, 1) AS BIGINT) AS camera
        FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderdate < TIMESTAMP '1998-07-01'),
    render_flags AS (
        SELECT o_orderkey AS pic_id, o_orderkey + 1000 AS design_id,
               CASE WHEN camera = 4 THEN -1 ELSE camera END AS camera_type_id,
               CASE camera WHEN 1 THEN '普通图' WHEN 2 THEN '全景图' WHEN 3 THEN '俯视图' ELSE '其它' END
                   AS camera_type_name,
               account_id, org_id, user_id, org_user_type,
               o_orderdate = TIMESTAMP '1998-06-30' AS "1d_is_created",
               gone AND o_orderdate >= TIMESTAMP '1998-06-30' AS "1d_is_deleted",
               o_orderdate >= TIMESTAMP '1998-06-01' AS "1m_is_created",
               gone AND o_orderdate >= TIMESTAMP '1998-06-01' AS "1m_is_deleted",
               gone AS deleted
        FROM images JOIN org_users ON owner = user_id)
    """


# Submitted designs. A line is a submission of design l_orderkey in order l_partkey. Lines with R
# are the day's relations, those with A lie one to seven days back, those with N are the designs'
# own details. Names of large parts are found only in history, some on two days, or nowhere.


def order_material(t: Tables) -> Catalog:
    submissions = t.lineitem.select(
        F.col("l_orderkey").alias("design_id"), F.col("l_partkey").alias("order_id"),
        F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("created"),
        (F.col("l_linenumber") == 7).alias("deleted"))
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("org_id"),
        when("o_orderpriority = '5-LOW'", 1, 0).alias("status"),
        F.expr("""CASE o_orderpriority WHEN '1-URGENT' THEN 27 WHEN '2-HIGH' THEN 29
                  WHEN '3-MEDIUM' THEN if(o_orderstatus = 'F', 31, 33)
                  ELSE CASE o_orderstatus WHEN 'F' THEN 30 WHEN 'O' THEN 1 ELSE 32 END END""").alias("state"),
        when("o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'", 1, 2).alias("template_id"),
        F.col("o_orderdate").alias("last_modified"),
        F.concat(F.lit("ORD-"), "o_orderkey").alias("order_readable_id"))
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        when("l_linenumber <= 2", "auditRelationId", "other").alias("item_key"),
        F.concat(F.lit("AR-"), "l_returnflag", "l_linestatus").alias("value"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("design_id"),
        F.col("l_partkey").alias("brandgood_id"),
        F.expr("""CASE l_linenumber WHEN 1 THEN 'furniture' WHEN 2 THEN 'material' WHEN 3 THEN 'molding'
                  WHEN 4 THEN 'customized' ELSE 'decoration' END""").alias("dhd_type"),
        F.col("l_quantity").cast("bigint").alias("b4110_1_design_brandgood_relation_cnt"),
        F.expr(f"""CASE l_returnflag WHEN 'R' THEN '{RUN.ds}' WHEN 'A' THEN
                   date_format(date_sub(DATE '1998-06-30', l_linenumber), 'yyyyMMdd') END""").alias("ds"))
    named = t.part.where("p_partkey <> 0").select(
        F.col("p_partkey").alias("brandgood_id"), F.col("p_name").alias("brandgood_name"), "p_size")
    names = union(
        dated(named.where("p_size <= 25")),
        dated(named.where("p_size BETWEEN 20 AND 40"), RUN.days_before(2)),
        dated(named.where("p_size BETWEEN 35 AND 45"), RUN.days_before(5)),
    ).drop("p_size")
    return Catalog(t.spark, {
        "order_design": dated(submissions),
        "order_info": dated(orders),
        "order_item": dated(items),
        "bridge": lines.where(F.col("ds").isNotNull()),
        "order_design_detail": dated(lines.where(F.col("ds").isNull()).select(
            "design_id", "brandgood_id", "dhd_type")),
        "material": names,
    })


ORDER_MATERIAL_SQL = """WITH
    submitted AS (
        SELECT l_orderkey AS design_id, l_partkey AS order_id, date_trunc('month', l_shipdate) AS created
        FROM lineitem WHERE l_linenumber <> 7),
    status(code, review_status) AS (
        VALUES (27, '待审核'), (28, '审核中'), (29, '已通过'), (30, '已撤回'), (31, '已驳回'), (32, '已退回')),
    live AS (
        SELECT o_orderkey AS order_id, o_custkey AS org_id, 'ORD-' || o_orderkey AS order_readable_id,
               o_orderdate AS last_modified, review_status
        FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 27 WHEN o_orderpriority = '2-HIGH' THEN 29
                             WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 31
                             WHEN o_orderpriority = '3-MEDIUM' THEN 33 ELSE 32 END AS state
              FROM orders
              WHERE o_orderpriority <> '5-LOW'
                AND NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus <> 'P')
                AND NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'))
        LEFT JOIN status ON state = code),
    audits AS (SELECT l_orderkey AS order_id, 'AR-' || l_returnflag || l_linestatus AS value
               FROM lineitem WHERE l_linenumber <= 2),
    core_tied AS (
        SELECT DISTINCT org_id, order_readable_id, design_id, value, created, review_status, last_modified
        FROM submitted s JOIN live USING (order_id) LEFT JOIN audits USING (order_id)
        WHERE created = (SELECT min(created) FROM submitted f WHERE f.design_id = s.design_id)),
    core AS (
        SELECT org_id, order_readable_id, design_id, value, created, review_status, last_modified
        FROM (SELECT * FROM submitted
              QUALIFY row_number() OVER (PARTITION BY design_id ORDER BY created, order_id) = 1)
        JOIN live USING (order_id) LEFT JOIN audits USING (order_id)),
    lines AS (
        SELECT l_orderkey AS design_id, l_partkey AS brandgood_id,
               CASE WHEN l_linenumber = 1 THEN 'furniture' WHEN l_linenumber = 2 THEN 'material'
                    WHEN l_linenumber = 3 THEN 'molding' WHEN l_linenumber = 4 THEN 'customized'
                    ELSE 'decoration' END AS dhd_type,
               CAST(l_quantity AS BIGINT) AS b4110_1_design_brandgood_relation_cnt,
               CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS level
        FROM lineitem),
    names AS (
        SELECT p_partkey AS brandgood_id, p_name AS brandgood_name, 1 AS level FROM part
        WHERE p_partkey <> 0 AND p_size <= 25
        UNION ALL SELECT p_partkey, p_name, 2 FROM part WHERE p_partkey <> 0 AND p_size BETWEEN 20 AND 40
        UNION ALL SELECT p_partkey, p_name, 2 FROM part WHERE p_partkey <> 0 AND p_size BETWEEN 35 AND 45),
    names_known AS (SELECT * FROM names UNION ALL SELECT 0, '未知商品', 3),
    two_levels AS (SELECT design_id, min(level) AS level FROM lines WHERE level <= 2 GROUP BY 1),
    three_levels AS (SELECT design_id, min(level) AS level FROM lines GROUP BY 1),
    name_level AS (SELECT brandgood_id, min(level) AS level FROM names_known GROUP BY 1),
    best_name AS (SELECT brandgood_id, brandgood_name, level FROM names_known
                  JOIN name_level USING (brandgood_id, level)),
    order_material_detail AS (
        SELECT core_tied.*, l.brandgood_id, dhd_type, b4110_1_design_brandgood_relation_cnt, brandgood_name
        FROM core_tied LEFT JOIN lines l ON l.design_id = core_tied.design_id AND l.level = 1
        LEFT JOIN names n ON n.brandgood_id = l.brandgood_id AND n.level = 1),
    order_material_onepass AS (
        SELECT core.*, l.brandgood_id, dhd_type, b4110_1_design_brandgood_relation_cnt, brandgood_name
        FROM core LEFT JOIN lines l ON l.design_id = core.design_id AND l.level = 1
        LEFT JOIN names n ON n.brandgood_id = l.brandgood_id AND n.level = 1),
    order_material_fallback AS (
        SELECT core.*, l.brandgood_id, dhd_type, b4110_1_design_brandgood_relation_cnt, brandgood_name
        FROM core LEFT JOIN (SELECT * FROM lines JOIN two_levels USING (design_id, level)) l
                  ON l.design_id = core.design_id
        LEFT JOIN best_name n ON n.brandgood_id = l.brandgood_id AND n.level <= 2),
    order_material_three_level AS (
        SELECT core.*, l.brandgood_id, dhd_type,
               CASE WHEN l.level = 1 THEN b4110_1_design_brandgood_relation_cnt ELSE 1 END
                   AS b4110_1_design_brandgood_relation_cnt,
               brandgood_name
        FROM core LEFT JOIN (SELECT * FROM lines JOIN three_levels USING (design_id, level)) l
                  ON l.design_id = core.design_id
        LEFT JOIN best_name n ON n.brandgood_id = l.brandgood_id),
    order_material_defaults AS (
        SELECT core.*, CAST(0 AS BIGINT) AS brandgood_id, 'unknown' AS dhd_type,
               CAST(1 AS BIGINT) AS b4110_1_design_brandgood_relation_cnt, '默认商品' AS brandgood_name FROM core),
    order_material_nulls AS (
        SELECT core.*, CAST(NULL AS BIGINT) AS brandgood_id, CAST(NULL AS VARCHAR) AS dhd_type,
               CAST(NULL AS BIGINT) AS b4110_1_design_brandgood_relation_cnt,
               CAST(NULL AS VARCHAR) AS brandgood_name FROM core),
    order_material_detail_source AS (
        SELECT core.*, l.brandgood_id, dhd_type, CAST(1 AS BIGINT) AS b4110_1_design_brandgood_relation_cnt,
               brandgood_name
        FROM core LEFT JOIN lines l ON l.design_id = core.design_id AND l.level = 3
        LEFT JOIN names n ON n.brandgood_id = l.brandgood_id AND n.level = 1)
    """


# The reward log: customers are yesterday's rows, events the day's changes.


def rewards(t: Tables) -> Catalog:
    log = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("task_id"),
        F.col("c_custkey").alias("user_id"),
        when("c_acctbal > 0", 1, 0).cast("bigint").alias("received"),
        F.lit(-1).cast("bigint").alias("user_task_id"),
        F.lit(0).cast("bigint").alias("turn"),
        F.col("c_mktsegment").alias("attach"),
        (F.col("c_acctbal") < 0).alias("deleted"),
        F.lit("2023-12-01").cast("timestamp_ntz").alias("created"),
        F.lit("2023-12-31").cast("timestamp_ntz").alias("lastmodified"),
        F.col("c_name").alias("reward_snapshot"),
        F.lit(None).cast("string").alias("receive_detail"),
    )
    changes = t.events.select(
        (F.col("user_id") * 20).alias("id"),
        F.col("user_id").alias("task_id"),
        F.col("user_id"),
        when("event_type = 'purchase'", 1, 0).cast("bigint").alias("received"),
        F.col("event_id").alias("user_task_id"),
        F.lit(1).cast("bigint").alias("turn"),
        F.col("event_type").alias("attach"),
        (F.col("event_type") == "error").alias("deleted"),
        F.col("ts").alias("created"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("lastmodified"),
        F.col("event_type").alias("reward_snapshot"),
        F.col("props").alias("receive_detail"),
    )
    return Catalog(t.spark, {
        "reward_snapshot": dated(log, RUN.prev_day), "reward_increment": dated(changes)})


REWARD_SQL = """WITH latest AS (
        SELECT user_id * 20 AS id, user_id AS task_id, user_id,
               CAST(CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS received,
               event_id AS user_task_id, CAST(1 AS BIGINT) AS turn, event_type AS attach,
               event_type = 'error' AS deleted, ts AS created, date_trunc('day', ts) AS lastmodified,
               event_type AS reward_snapshot, props AS receive_detail
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id
                                   ORDER BY date_trunc('day', ts) DESC, received DESC, event_id DESC) = 1),
    reward_merge AS (
        SELECT * FROM latest
        UNION ALL
        SELECT c_custkey, c_nationkey, c_custkey, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END, -1, 0,
               c_mktsegment, c_acctbal < 0, TIMESTAMP '2023-12-01', TIMESTAMP '2023-12-31', c_name, NULL
        FROM customer WHERE c_custkey NOT IN (SELECT id FROM latest))
    """


# Relation tags: lines as they were on the three days, with orders, users, parts and, from nations,
# the decoration categories (the first five without a child).


def relation_tags(t: Tables) -> Catalog:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("design_id"), F.col("l_partkey").alias("brandgood_id"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 'furniture' WHEN 'A' THEN 'customized' ELSE 'decoration' END")
        .alias("dhd_type"), "l_shipdate")
    as_of = [
        dated(lines.where(F.col("l_shipdate") <= F.to_date(F.lit(ds), "yyyyMMdd")), ds)
        for ds in (RUN.ds, RUN.prev_day, RUN.prev_month_end)
    ]
    size = F.col("p_size").cast("bigint")
    materials = t.part.select(
        F.col("p_partkey").alias("brandgood_id"),
        size.alias("item_type"),
        F.nullif(size, F.lit(9)).alias("transprod_cat_id"),
        F.nullif(size, F.lit(7)).alias("prodcat1_id"),
        F.nullif("p_type", F.lit("PROMO")).alias("prodcat1_name"),
        (size + 100).alias("prodcat2_id"),
        F.col("p_brand").alias("prodcat2_name"),
        F.nullif(size + 200, F.lit(210)).alias("prodcat3_id"),
        F.nullif("p_brand", F.lit("Brand#9")).alias("prodcat3_name"),
    )
    designs = t.orders.select(
        F.col("o_orderkey").alias("design_id"), F.col("o_custkey").alias("user_id"),
        (F.col("o_orderstatus") == "F").alias("deleted"),
        F.col("o_orderpriority").alias("fpspec_devide_1"), F.col("o_orderstatus").alias("area_devide_1"))
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    users = places.select(
        F.col("c_custkey").alias("user_id"),
        F.nullif(F.col("n_regionkey").cast("bigint"), F.lit(4)).alias("province"),
        when("n_regionkey <> 4", F.col("r_name")).alias("province_name"),
        F.nullif(F.col("n_nationkey").cast("bigint"), F.lit(8)).alias("city"),
        when("n_nationkey <> 8", F.col("n_name")).alias("city_name"))
    deco = t.nation.select(
        F.col("n_regionkey").cast("string").alias("cat1_id"),
        F.concat(F.lit("group "), "n_regionkey").alias("cat1_name"),
        when("n_nationkey >= 5", F.col("n_nationkey").cast("string")).alias("cat2_id"),
        when("n_nationkey >= 5", F.col("n_name")).alias("cat2_name"))
    usable = t.part.select(
        (size % 25).alias("org_id"), F.col("p_partkey").alias("brandgood_id"),
        F.nullif(F.col("p_size") % 6, F.lit(5)).alias("authorization_method"), size.alias("src_org_id"))
    return Catalog(t.spark, {
        "bridge": union(*as_of).drop("l_shipdate"),
        "material": dated(materials),
        "design": dated(designs),
        "org_user": dated(org_users(t)),
        "user": dated(users),
        "deco_category": dated(deco),
        "usable_material": dated(usable),
    })


def relation_tags_sql(created: str) -> str:
    return f"""WITH {ORG_USERS},
    lines AS (SELECT l_orderkey, l_partkey, l_returnflag, l_shipdate FROM lineitem),
    cur AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1998-07-01'),
    yday AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1998-06-30'),
    mon AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1998-06-01'),
    deco AS (
        SELECT CASE WHEN n_nationkey < 5 THEN n_regionkey ELSE n_nationkey END AS id, n_regionkey AS parent,
               'group ' || n_regionkey AS parent_name,
               CASE WHEN n_nationkey < 5 THEN 'group ' || n_regionkey ELSE n_name END AS name
        FROM nation),
    {created},
    relation_tags AS (
        SELECT c.l_orderkey AS design_id, c.l_partkey AS brandgood_id,
               CAST(CASE WHEN l_returnflag = 'R' THEN 1
                         WHEN l_returnflag = 'A' AND p_size IN (3, 8, 9, 14, 15, 19, 24) THEN 2
                         WHEN l_returnflag = 'N' AND d.id IS NOT NULL THEN 3 ELSE 0 END AS BIGINT) AS itemset_type,
               o_custkey AS user_id,
               CAST(CASE n.n_regionkey WHEN 4 THEN -1 ELSE n.n_regionkey END AS BIGINT) AS province,
               CASE n.n_regionkey WHEN 4 THEN '' ELSE r_name END AS province_name,
               CAST(CASE n.n_nationkey WHEN 8 THEN -1 ELSE n.n_nationkey END AS BIGINT) AS city,
               CASE n.n_nationkey WHEN 8 THEN '' ELSE n.n_name END AS city_name,
               account_id, org_user_type, org_id,
               o_orderpriority AS fpspec_devide_1, o_orderstatus AS area_devide_1,
               o_orderstatus = 'F' AS deleted,
               CAST(CASE p_size WHEN 7 THEN -1 ELSE p_size END AS BIGINT) AS prodcat1_id,
               CASE p_type WHEN 'PROMO' THEN '' ELSE p_type END AS prodcat1_name,
               CAST(p_size + 100 AS BIGINT) AS prodcat2_id, p_brand AS prodcat2_name,
               CAST(CASE p_size WHEN 10 THEN -1 ELSE p_size + 200 END AS BIGINT) AS prodcat3_id,
               CASE p_brand WHEN 'Brand#9' THEN '' ELSE p_brand END AS prodcat3_name,
               new_today AS "1d_is_created", new_this_month AS "1m_is_created",
               CAST(p_size AS BIGINT) AS item_type,
               CASE WHEN org_id = p_size % 25 THEN
                    CASE WHEN p_size % 6 = 0 THEN '自建' WHEN p_size % 6 < 4 THEN '授权' ELSE '公库' END END
                   AS usable_bg_source,
               CAST(CASE WHEN org_id = p_size % 25 THEN p_size END AS BIGINT) AS src_org_id,
               CAST(CASE WHEN l_returnflag = 'N' THEN d.parent END AS BIGINT) AS deco_cat1_id,
               CASE WHEN l_returnflag = 'N' THEN d.parent_name END AS deco_cat1_name,
               CAST(CASE WHEN l_returnflag = 'N' THEN d.id END AS BIGINT) AS deco_cat2_id,
               CASE WHEN l_returnflag = 'N' THEN d.name END AS deco_cat2_name
        FROM created c JOIN orders ON c.l_orderkey = o_orderkey JOIN org_users ON o_custkey = user_id
        JOIN customer ON c_custkey = o_custkey JOIN nation n ON c_nationkey = n.n_nationkey
        JOIN region ON n.n_regionkey = r_regionkey JOIN part ON c.l_partkey = p_partkey
        LEFT JOIN deco d ON d.id = nullif(p_size, 9))
    """


RELATION_TAGS_SQL = relation_tags_sql("""created AS (
        SELECT cur.*,
               NOT EXISTS (SELECT 1 FROM yday y WHERE y.l_orderkey = cur.l_orderkey
                           AND y.l_partkey = cur.l_partkey AND y.l_returnflag = cur.l_returnflag) AS new_today,
               NOT EXISTS (SELECT 1 FROM mon m WHERE m.l_orderkey = cur.l_orderkey
                           AND m.l_partkey = cur.l_partkey AND m.l_returnflag = cur.l_returnflag) AS new_this_month
        FROM cur)""")
RELATION_TAGS_LITERAL_SQL = relation_tags_sql("""created AS (
        SELECT cur.*, y.l_orderkey IS NULL AS new_today, m.l_orderkey IS NULL AS new_this_month
        FROM cur
        LEFT JOIN yday y ON (y.l_orderkey, y.l_partkey, y.l_returnflag)
                          = (cur.l_orderkey, cur.l_partkey, cur.l_returnflag)
        LEFT JOIN mon m ON (m.l_orderkey, m.l_partkey, m.l_returnflag)
                         = (cur.l_orderkey, cur.l_partkey, cur.l_returnflag))""")
