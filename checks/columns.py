"""Projections, filters, expressions and dates."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import RATED, RUN, Tables, query
from dayledger.functions import (
    category_filter,
    child_or_parent,
    eq,
    fill_defaults,
    fill_missing,
    first_rule,
    flag,
    format_ds,
    in_list,
    label,
    month_key,
    month_start,
    not_in_list,
    parse_ds,
    period_flags,
    prev_month_end,
    remap,
    same_month,
    to_bigint,
)

# Projections


@query("SELECT o_orderkey AS design_id, o_custkey AS user_id, o_orderdate AS created FROM orders")
def project_rename(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("design_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("created"))


@query("SELECT n_nationkey AS area_id, n_name AS name, 'city' AS area_type FROM nation")
def project_literal(t: Tables):
    return t.nation.select(
        F.col("n_nationkey").alias("area_id"), F.col("n_name").alias("name"),
        F.lit("city").alias("area_type"))


MATERIAL = T.StructType([
    T.StructField("brandgood_id", T.LongType()),
    T.StructField("dhd_type", T.StringType()),
    T.StructField("relation_cnt", T.LongType()),
])


@query("""SELECT o_orderkey, CAST(NULL AS BIGINT) AS brandgood_id, CAST(NULL AS VARCHAR) AS dhd_type,
                 CAST(NULL AS BIGINT) AS relation_cnt FROM orders""")
def project_typed_nulls(t: Tables):
    return fill_missing(t.orders.select("o_orderkey"), MATERIAL)


@query("""SELECT o_orderkey, CAST(0 AS BIGINT) AS brandgood_id, 'unknown' AS dhd_type,
                 CAST(1 AS BIGINT) AS relation_cnt FROM orders""")
def project_defaults(t: Tables):
    defaults = {"brandgood_id": 0, "dhd_type": "unknown", "relation_cnt": 1}
    return fill_defaults(t.orders.select("o_orderkey"), defaults, MATERIAL)


@query("""SELECT o_orderkey, o_orderdate >= TIMESTAMP '1998-06-30' AS "1d_is_created" FROM orders""")
def digit_led_columns(t: Tables):
    return t.orders.select(
        "o_orderkey", (F.col("o_orderdate") >= F.lit(RUN.day)).alias("1d_is_created"))


# Filters


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_equality(t: Tables):
    return t.orders.where(eq("o_orderpriority", "1-URGENT")).select("o_orderkey", "o_totalprice")


@query(f"WITH {RATED} SELECT o_orderkey, maybe_done FROM rated WHERE NOT maybe_done")
def filter_boolean(t: Tables):
    return t.rated.where(eq("maybe_done", False)).select("o_orderkey", "maybe_done")


@query(f"WITH {RATED} SELECT o_orderkey FROM rated WHERE code IN (1, 3) AND o_orderstatus IN ('F', 'O')")
def filter_in_list(t: Tables):
    return t.rated.where(
        in_list("code", [1, 3]) & in_list("o_orderstatus", ["F", "O"])).select("o_orderkey")


@query(f"WITH {RATED} SELECT o_orderkey FROM rated WHERE maybe_status NOT IN ('F', 'X')")
def filter_not_in_list(t: Tables):
    return t.rated.where(not_in_list("maybe_status", ["F", "X"])).select("o_orderkey")


@query(f"WITH {RATED} SELECT o_orderkey FROM rated WHERE maybe_status IS NULL")
def filter_is_null(t: Tables):
    return t.rated.where(F.col("maybe_status").isNull()).select("o_orderkey")


@query(f"WITH {RATED} SELECT o_orderkey, maybe_status FROM rated WHERE maybe_status IS NOT NULL")
def filter_is_not_null(t: Tables):
    return t.rated.where(F.col("maybe_status").isNotNull()).select("o_orderkey", "maybe_status")


@query("""SELECT p_partkey, p_type, p_brand, p_size FROM part
          WHERE p_type IN ('ECONOMY', 'LARGE')
             OR (p_type = 'PROMO' AND p_brand = 'Brand#7')
             OR (p_type = 'STANDARD' AND p_brand IN ('Brand#1', 'Brand#2') AND p_size IN (5, 10, 15))""")
def filter_category_rules(t: Tables):
    rules = [
        [["ECONOMY", "LARGE"]],
        [["PROMO"], ["Brand#7"]],
        [["STANDARD"], ["Brand#1", "Brand#2"], [5, 10, 15]],
    ]
    cols = ["p_type", "p_brand", "p_size"]
    return t.part.where(category_filter(cols, rules)).select("p_partkey", *cols)


@query("""SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y%m') AS month FROM orders
          WHERE strftime(o_orderdate, '%Y%m') = '199806'""")
def filter_same_month(t: Tables):
    return t.orders.where(same_month("o_orderdate", RUN)).select(
        "o_orderkey", "o_orderdate", month_key("o_orderdate").alias("month"))


@query("""SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey
          WHERE o_orderkey IS NOT NULL""")
def filter_after_outer_join(t: Tables):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").where(
        F.col("o_orderkey").isNotNull()).select("c_custkey", "o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, s_nationkey
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
          WHERE s_nationkey = c_nationkey""")
def filter_cross_relation(t: Tables):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    placed = lines.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return placed.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).where(
        F.col("s_nationkey") == F.col("c_nationkey")
    ).select("l_orderkey", "l_linenumber", "s_nationkey")


@query(f"WITH {RATED} SELECT o_orderkey, o_custkey FROM rated WHERE maybe_done OR o_custkey = 1")
def filter_disjunction(t: Tables):
    return t.rated.where(eq("maybe_done", True) | eq("o_custkey", 1)).select("o_orderkey", "o_custkey")


# Expressions


@query(f"""WITH {RATED} SELECT o_orderkey, CASE code WHEN 1 THEN 'waiting' WHEN 2 THEN 'passed' END AS status
           FROM rated""")
def case_label(t: Tables):
    return t.rated.select("o_orderkey", label("code", {1: "waiting", 2: "passed"}).alias("status"))


@query(f"""WITH {RATED} SELECT o_orderkey,
                  CASE maybe_status WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS status
           FROM rated""")
def case_label_default(t: Tables):
    return t.rated.select(
        "o_orderkey", label("maybe_status", {"F": "done", "O": "open"}, "other").alias("status"))


@query(f"""WITH {RATED} SELECT o_orderkey, coalesce(maybe_done, false) AS done,
                  CASE WHEN maybe_done OR code = 1 THEN true ELSE false END AS done_or_urgent,
                  CASE WHEN maybe_done AND code = 1 THEN true ELSE false END AS done_and_urgent
           FROM rated""")
def case_flag(t: Tables):
    done, urgent = F.col("maybe_done"), eq("code", 1)
    return t.rated.select(
        "o_orderkey", flag(done).alias("done"), flag(done | urgent).alias("done_or_urgent"),
        flag(done & urgent).alias("done_and_urgent"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
                 CASE WHEN l_returnflag = 'A' THEN 1
                      WHEN l_returnflag = 'N' AND p_size IN (3, 8, 9, 14, 15, 19, 24) THEN 2
                      WHEN l_returnflag = 'R' AND n_nationkey IS NOT NULL THEN 3 ELSE 0 END AS itemset
          FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN nation ON p_size = n_nationkey""")
def case_rules(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.nation, F.col("p_size") == F.col("n_nationkey"), "left")
    rules = [
        (eq("l_returnflag", "A"), 1),
        (eq("l_returnflag", "N") & in_list("p_size", [3, 8, 9, 14, 15, 19, 24]), 2),
        (eq("l_returnflag", "R") & F.col("n_nationkey").isNotNull(), 3),
    ]
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", first_rule(rules, 0).alias("itemset"))


@query(f"""WITH {RATED} SELECT o_orderkey, CASE WHEN nullif(code, 3) IS NULL THEN -1 ELSE code END AS code
           FROM rated""")
def case_null_default(t: Tables):
    return t.rated.select(
        "o_orderkey", F.coalesce(F.nullif("code", F.lit(3)), F.lit(-1)).alias("code"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey = 1 THEN o_orderkey ELSE o_custkey END AS owner FROM orders""")
def case_key_remap(t: Tables):
    return t.orders.select("o_orderkey", remap("o_custkey", 1, F.col("o_orderkey")).alias("owner"))


@query(f"""WITH {RATED} SELECT o_orderkey, CASE WHEN nullif(code, 5) = 4 THEN 'own'
                  WHEN nullif(code, 5) IN (1, 2) THEN 'licensed' ELSE 'public' END AS source FROM rated""")
def case_in_set(t: Tables):
    code = F.nullif("code", F.lit(5))
    return t.rated.select("o_orderkey", label(code, {4: "own", (1, 2): "licensed"}, "public").alias("source"))


@query("""SELECT n_nationkey, coalesce(nullif(n_nationkey, 3), n_regionkey) AS id,
                 coalesce(nullif(n_name, 'NATION_3'), r_name) AS name
          FROM nation JOIN region ON n_regionkey = r_regionkey""")
def parent_level_fallback(t: Tables):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey",
        child_or_parent(F.nullif("n_nationkey", F.lit(3)), "n_regionkey").alias("id"),
        child_or_parent(F.nullif("n_name", F.lit("NATION_3")), "r_name").alias("name"))


@query(f"""WITH {RATED} SELECT o_orderkey, coalesce(maybe_status, '') AS status,
                  coalesce(nullif(o_custkey, 7), -1) AS custkey FROM rated""")
def coalesce_default(t: Tables):
    return t.rated.select(
        "o_orderkey", F.coalesce("maybe_status", F.lit("")).alias("status"),
        F.coalesce(F.nullif("o_custkey", F.lit(7)), F.lit(-1)).alias("custkey"))


@query("""SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS id, TRY_CAST(c_name AS BIGINT) AS dirty_id
          FROM customer""")
def cast_bigint(t: Tables):
    return t.customer.select(
        "c_custkey", to_bigint(F.substring("c_name", 10, 20)).alias("id"),
        to_bigint("c_name", strict=False).alias("dirty_id"))


# Dates


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ds, strftime(o_orderdate, '%Y%m') AS month
          FROM orders""")
def date_format(t: Tables):
    return t.orders.select(
        "o_orderkey", format_ds("o_orderdate").alias("ds"), month_key("o_orderdate").alias("month"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_parse(t: Tables):
    return t.orders.select("o_orderkey", parse_ds(format_ds("o_orderdate")).alias("day"))


@query("SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders")
def date_month_start(t: Tables):
    return t.orders.select("o_orderkey", month_start("o_orderdate").alias("month_start"))


@query("""SELECT o_orderkey, CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS day_before,
                 CAST(o_orderdate - INTERVAL 7 DAY AS DATE) AS week_before FROM orders""")
def date_sub_days(t: Tables):
    return t.orders.select(
        "o_orderkey", F.date_sub("o_orderdate", 1).alias("day_before"),
        F.date_sub("o_orderdate", 7).alias("week_before"))


@query("SELECT o_orderkey, CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS month_before FROM orders")
def date_add_months(t: Tables):
    return t.orders.select("o_orderkey", F.add_months("o_orderdate", -1).alias("month_before"))


@query("""SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS DATE) AS month_end
          FROM orders""")
def date_prev_month_end(t: Tables):
    return t.orders.select("o_orderkey", prev_month_end("o_orderdate").alias("month_end"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') = '19980630' AS created_today,
                 strftime(o_orderdate, '%Y%m') = '199806' AS created_this_month FROM orders""")
def date_period_flags(t: Tables):
    today, this_month = period_flags("o_orderdate", RUN)
    return t.orders.select(
        "o_orderkey", today.alias("created_today"), this_month.alias("created_this_month"))
