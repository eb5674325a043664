"""Joins, windows, aggregates, set operations and audits."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import DAILY, RUN, Tables, query
from dayledger import RunDate
from dayledger.functions import eq, label
from dayledger.operators import (
    advance_ledger,
    anti,
    audit_nulls,
    audit_partitions,
    audit_result,
    audit_sources,
    audit_trend,
    checked_broadcast,
    count_bitmaps,
    count_distinct_by,
    count_rows,
    dedup,
    distinct_bitmaps,
    fallback_join,
    join_when,
    ledger_diff,
    lookup,
    mark,
    month_to_date_bitmaps,
    salted_join,
    semi,
    start_ledger,
    top_n,
)
from dayledger.operators import audit_skew as heaviest_keys
from dayledger.operators import duplicate_keys as keys_repeated
from dayledger.operators import first_per_key as first_rows
from dayledger.operators import hot_keys
from dayledger.operators import latest_per_key as latest_rows
from dayledger.operators import merge_increment as merge
from dayledger.operators import snapshot_diff as diff
from dayledger.sinks import stage
from dayledger.sources import snapshot, trailing_days

# Joins


@query("SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t: Tables):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_custkey", "c_name")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, c_custkey, c_nationkey
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
          JOIN customer ON c_custkey = o_custkey AND c_nationkey = s_nationkey""")
def join_two_parents(t: Tables):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    both = [F.col("o_custkey") == F.col("c_custkey"), F.col("s_nationkey") == F.col("c_nationkey")]
    return lines.join(t.customer, both).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "c_custkey", "c_nationkey")


@query("SELECT o_orderkey, l_partkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def join_left(t: Tables):
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "l_partkey", "l_linenumber")


@query("""SELECT l.l_orderkey, l.l_partkey, l.l_returnflag, l.l_linenumber, r.cnt
          FROM lineitem l LEFT JOIN (
              SELECT l_orderkey, l_partkey, l_returnflag, count(*) AS cnt FROM lineitem
              WHERE l_linestatus = 'F' GROUP BY ALL) r
          USING (l_orderkey, l_partkey, l_returnflag)""")
def join_left_composite(t: Tables):
    keys = ["l_orderkey", "l_partkey", "l_returnflag"]
    finished = count_rows(t.lineitem.where(eq("l_linestatus", "F")), keys)
    return t.lineitem.select(*keys, "l_linenumber").join(finished, keys, "left")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, p_name
          FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_returnflag = 'R'""")
def join_conditional_left(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return join_when(lines, parts, ["l_partkey"], when=eq("l_returnflag", "R"))


FALLBACK = f"""WITH {DAILY},
    one AS (SELECT l_orderkey, l_partkey FROM daily WHERE ds BETWEEN '19980624' AND '19980630'),
    two AS (SELECT l_orderkey, l_partkey FROM daily WHERE ds BETWEEN '19980525' AND '19980623'),
    three AS (SELECT l_orderkey, l_partkey FROM daily WHERE l_returnflag = 'R'),
    first AS (SELECT o_orderkey, one.l_partkey, 1 AS level FROM orders JOIN one ON o_orderkey = l_orderkey),
    second AS (SELECT o_orderkey, two.l_partkey, 2 AS level FROM orders JOIN two ON o_orderkey = l_orderkey
               WHERE o_orderkey NOT IN (SELECT o_orderkey FROM first)),
    third AS (SELECT o_orderkey, three.l_partkey, 3 AS level FROM orders JOIN three ON o_orderkey = l_orderkey
              WHERE o_orderkey NOT IN (SELECT o_orderkey FROM first)
                AND o_orderkey NOT IN (SELECT o_orderkey FROM second)),
    first_two AS (SELECT * FROM first UNION ALL SELECT * FROM second),
    all_three AS (SELECT * FROM first_two UNION ALL SELECT * FROM third)
"""


def _fallback(t: Tables, *more, **kwargs):
    base = t.orders.select("o_orderkey")
    days = t.daily.withColumnRenamed("l_orderkey", "o_orderkey")
    sources = [
        days.where(F.col("ds").between(RUN.days_before(6), RUN.ds)),
        days.where(F.col("ds").between(RUN.days_before(36), RUN.days_before(7))),
        *[days.where(cond) for cond in more],
    ]
    return fallback_join(base, sources, ["o_orderkey"], ["l_partkey"], level="level", **kwargs)


@query(FALLBACK + """
    SELECT o_orderkey, l_partkey, level FROM first_two
    UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM first_two)""")
def join_fallback(t: Tables):
    return _fallback(t)


@query(FALLBACK + """
    SELECT o_orderkey, l_partkey, level FROM all_three
    UNION ALL SELECT o_orderkey, NULL, NULL FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM all_three)""")
def join_fallback_three(t: Tables):
    return _fallback(t, eq("l_returnflag", "R"), prefilter=True)


@query(f"""WITH {DAILY}, last AS (
        SELECT l_orderkey, max(ds) AS ds FROM daily WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT o_orderkey, l_partkey FROM orders LEFT JOIN (
        SELECT l_orderkey, l_partkey FROM daily JOIN last USING (l_orderkey, ds)
        WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey""")
def join_fallback_latest(t: Tables):
    source = t.daily.where(eq("l_returnflag", "R")).withColumnRenamed("l_orderkey", "o_orderkey")
    return fallback_join(t.orders.select("o_orderkey"), [source], ["o_orderkey"], ["l_partkey"],
                         latest_only=True)


@query("""SELECT l_orderkey, l_linenumber, p_partkey, p_name FROM lineitem
          LEFT JOIN part ON coalesce(CASE WHEN l_returnflag = 'R' THEN l_partkey END, l_suppkey) = p_partkey""")
def join_computed_key(t: Tables):
    key = F.coalesce(F.when(eq("l_returnflag", "R"), F.col("l_partkey")), F.col("l_suppkey"))
    return t.lineitem.join(t.part, key == F.col("p_partkey"), "left").select(
        "l_orderkey", "l_linenumber", "p_partkey", "p_name")


@query("""SELECT DISTINCT l_orderkey, l_partkey FROM lineitem
          WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)""")
def join_semi_dedup(t: Tables):
    small = t.part.where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("l_partkey"))
    return dedup(semi(t.lineitem, small, ["l_partkey"]), ["l_orderkey", "l_partkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def join_semi(t: Tables):
    buyers = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return semi(t.customer.select("c_custkey", "c_name"), buyers, ["c_custkey"])


@query("SELECT c_custkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey")
def join_key_filter(t: Tables):
    buyers = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(buyers, "c_custkey")


@query("""SELECT c_custkey, c_name FROM customer
          WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""")
def join_anti(t: Tables):
    active = t.events.select(F.col("user_id").alias("c_custkey"))
    return anti(t.customer.select("c_custkey", "c_name"), active, ["c_custkey"])


@query("""SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
                 AS has_return FROM orders""")
def join_mark(t: Tables):
    returned = t.lineitem.where(eq("l_returnflag", "R")).select(F.col("l_orderkey").alias("o_orderkey"))
    return mark(t.orders.select("o_orderkey"), returned, ["o_orderkey"], "has_return")


TRIPLE = ["l_orderkey", "l_partkey", "l_returnflag"]
AS_OF = "WITH " + ", ".join(
    f"{name} AS (SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_shipdate < TIMESTAMP '{day}')"
    for name, day in [("cur", "1998-07-01"), ("yday", "1998-06-30"), ("mon", "1998-06-01")])


def _as_of(t: Tables):
    """The relation's snapshots of the run day, the day before and the last month's end."""
    days = [(RUN.ds, "1998-07-01"), (RUN.prev_day, "1998-06-30"), (RUN.prev_month_end, "1998-06-01")]
    snapshots = [
        t.lineitem.where(F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))
        .select(*TRIPLE, F.lit(ds).alias("ds")) for ds, end in days
    ]
    return snapshots[0].unionByName(snapshots[1]).unionByName(snapshots[2])


@query(AS_OF + """
    SELECT l_orderkey, l_partkey, l_returnflag,
           (l_orderkey, l_partkey, l_returnflag) NOT IN (SELECT row(l_orderkey, l_partkey, l_returnflag) FROM yday)
               AS new_today,
           (l_orderkey, l_partkey, l_returnflag) NOT IN (SELECT row(l_orderkey, l_partkey, l_returnflag) FROM mon)
               AS new_this_month
    FROM cur""")
def snapshot_diff(t: Tables):
    return diff(_as_of(t), TRIPLE, RUN, "new_today", "new_this_month").drop("ds")


@query(AS_OF + """
    SELECT cur.l_orderkey, cur.l_partkey, cur.l_returnflag, yday.l_orderkey IS NULL AS new_today,
           mon.l_orderkey IS NULL AS new_this_month
    FROM cur LEFT JOIN yday ON cur.l_orderkey = yday.l_orderkey AND cur.l_partkey = yday.l_partkey
                           AND cur.l_returnflag = yday.l_returnflag
             LEFT JOIN mon ON cur.l_orderkey = mon.l_orderkey AND cur.l_partkey = mon.l_partkey
                          AND cur.l_returnflag = mon.l_returnflag""")
def snapshot_diff_literal(t: Tables):
    return diff(_as_of(t), TRIPLE, RUN, "new_today", "new_this_month", dedup=False).drop("ds")


@query(AS_OF + """
    SELECT cur.*, NOT EXISTS (SELECT 1 FROM yday WHERE (yday.l_orderkey, yday.l_partkey, yday.l_returnflag)
                                                     = (cur.l_orderkey, cur.l_partkey, cur.l_returnflag)) AS new_today,
           NOT EXISTS (SELECT 1 FROM mon WHERE (mon.l_orderkey, mon.l_partkey, mon.l_returnflag)
                                             = (cur.l_orderkey, cur.l_partkey, cur.l_returnflag)) AS new_this_month
    FROM cur""")
def snapshot_diff_ledger(t: Tables):
    """The same difference from a ledger that was moved on day by day, where a day was written."""
    days = _as_of(t)
    month_end, yesterday = RunDate.parse(RUN.prev_month_end), RunDate.parse(RUN.prev_day)
    ledger = stage(start_ledger(snapshot(days, month_end.ds), TRIPLE, month_end), "ledger")
    for day in (yesterday, RUN):
        ledger = stage(advance_ledger(ledger, snapshot(days, day.ds), TRIPLE, day, keep_from=RUN.prev_month_end), "ledger")
    return ledger_diff(snapshot(days, RUN.ds), ledger, TRIPLE, RUN, "new_today", "new_this_month").drop("ds")


@query("""SELECT l_orderkey, l_linenumber, c_nationkey, s_nationkey, cn.n_name AS customer_nation,
                 sn.n_name AS supplier_nation
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN supplier ON l_suppkey = s_suppkey
          LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey
          LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey""")
def join_role_playing(t: Tables):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select("l_orderkey", "l_linenumber", "c_nationkey", "s_nationkey")
    return lookup(rows, t.nation, "n_nationkey", "n_name",
                  {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"})


@query("""SELECT l_orderkey, l_linenumber, o_orderpriority, c_mktsegment, n_name, r_name, p_name, s_name
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def join_star(t: Tables):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select("l_orderkey", "l_linenumber", "o_orderpriority", "c_mktsegment", "n_name", "r_name",
                "p_name", "s_name")
    )


@query("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_broadcast(t: Tables):
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.select("o_orderkey", "o_custkey").join(checked_broadcast(segments), "o_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def join_salted(t: Tables):
    """Parts are far from hot here; the low bar makes the join spread hundreds of them."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return salted_join(lines, parts, ["l_partkey"], ways=4, min_rows=40)


@query("""SELECT c_custkey, c_name, event_id, event_type FROM customer LEFT JOIN events ON user_id = c_custkey""")
def join_salted_left(t: Tables):
    """Customers without an event stay; the busiest users are spread on the right."""
    events = t.events.select(F.col("user_id").alias("c_custkey"), "event_id", "event_type")
    return salted_join(t.customer.select("c_custkey", "c_name"), events, ["c_custkey"], "left",
                       ways=4, min_rows=60)


@query("""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, r.l_extendedprice AS price
          FROM lineitem l JOIN lineitem r ON l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey""")
def join_salted_composite(t: Tables):
    """Keys of two columns; the bar of two rows makes hundreds of them hot on both sides."""
    key = ["l_partkey", "l_suppkey"]
    left = t.lineitem.select("l_orderkey", "l_linenumber", *key)
    right = t.lineitem.select(*key, F.col("l_extendedprice").alias("price"))
    return salted_join(left, right, key, ways=4, share=0.001, min_rows=2)


# Aggregates


@query("""SELECT l_returnflag, l_linestatus, p_type, p_brand, count(DISTINCT l_orderkey) AS orders
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def agg_count_distinct(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return count_distinct_by(
        rows, ["l_returnflag", "l_linestatus", "p_type", "p_brand"], "l_orderkey", "orders")


@query(f"""WITH {DAILY},
    days AS (SELECT DISTINCT ds FROM daily WHERE ds BETWEEN '19970601' AND '19970608')
    SELECT days.ds, l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts
    FROM days JOIN daily ON daily.ds BETWEEN '19970601' AND days.ds GROUP BY ALL""")
def agg_distinct_month_to_date(t: Tables):
    """Exact distinct counts of the month to date, each day from the day before and the day's rows."""
    keys = ["l_returnflag", "l_linestatus"]
    month = t.daily.where(F.col("ds").between("19970601", "19970608"))
    counts, so_far = [], {}
    for day in [f"199706{d:02d}" for d in range(1, 9)]:
        rows = month.where(F.col("ds") == day)
        for col, name in (("l_orderkey", "orders"), ("l_partkey", "parts")):
            so_far[col] = stage(month_to_date_bitmaps(so_far.get(col), distinct_bitmaps(rows, keys, col), keys), f"mtd-{col}")
        both = count_bitmaps(so_far["l_orderkey"], keys, "orders").join(count_bitmaps(so_far["l_partkey"], keys, "parts"), keys)
        counts.append(both.select(F.lit(day).alias("ds"), *keys, "orders", "parts"))
    return reduce(DataFrame.unionByName, counts)


@query("SELECT l_orderkey, l_partkey FROM lineitem GROUP BY l_orderkey, l_partkey")
def agg_group_dedup(t: Tables):
    return dedup(t.lineitem, ["l_orderkey", "l_partkey"])


@query("""SELECT c_nationkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def agg_group_by_case(t: Tables):
    status = label("o_orderstatus", {"F": "finished", "O": "open"}).alias("status")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return dedup(rows.select("c_nationkey", status))


@query("SELECT DISTINCT l_partkey FROM lineitem")
def agg_distinct(t: Tables):
    return dedup(t.lineitem, ["l_partkey"])


@query("""SELECT count(*) AS cnt FROM lineitem""")
def agg_count_all(t: Tables):
    return count_rows(t.lineitem)


@query(f"WITH {DAILY} SELECT ds, count(*) AS cnt FROM daily GROUP BY ds")
def agg_count_per_partition(t: Tables):
    return count_rows(t.daily, ["ds"])


# Windows


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
          QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS FIRST) = 1""")
def first_per_key_ties(t: Tables):
    return first_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
                      ["l_orderkey"], ["l_linenumber"], ties=True)


@query("""SELECT user_id, event_type, event_id FROM events
          QUALIFY rank() OVER (PARTITION BY user_id ORDER BY event_type NULLS FIRST) = 1""")
def first_per_key_ties_hot(t: Tables):
    """Many ties per user, and the busiest users taken out of the window."""
    events = t.events.select("user_id", "event_type", "event_id")
    return first_rows(events, ["user_id"], ["event_type"], ties=True,
                      hot=hot_keys(events, ["user_id"], min_rows=60))


@query("""SELECT nullif(user_id % 5, 0) AS kind, event_type, event_id FROM events
          QUALIFY rank() OVER (PARTITION BY nullif(user_id % 5, 0) ORDER BY event_type NULLS FIRST) = 1""")
def first_per_key_ties_null(t: Tables):
    """A fifth of the rows has no key; they are held apart from the window."""
    kind = F.expr("nullif(user_id % 5, 0)").alias("kind")
    return first_rows(t.events.select(kind, "event_type", "event_id"), ["kind"], ["event_type"], ties=True, hot=[])


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_orderkey
                                     ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST) = 1""")
def first_per_key(t: Tables):
    return first_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
                      ["l_orderkey"], ["l_linenumber"], tiebreak=["l_partkey"])


@query("""SELECT user_id, event_id, ts, event_type FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id
                                     ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""")
def latest_per_key(t: Tables):
    return latest_rows(t.events.select("user_id", "event_id", "ts", "event_type"),
                       ["user_id"], ["ts"], ["event_id"])


# Order and limit, set operations


@query(f"WITH {DAILY} SELECT ds, count(*) AS cnt FROM daily GROUP BY ds ORDER BY ds DESC LIMIT 10")
def topk_latest_partitions(t: Tables):
    return top_n(count_rows(t.daily, ["ds"]), [F.col("ds").desc()], 10)


@query(f"WITH {DAILY} SELECT ds, count(*) AS cnt FROM daily GROUP BY ds ORDER BY ds DESC")
def sort_partitions(t: Tables):
    return count_rows(t.daily, ["ds"]).orderBy(F.col("ds").desc())


@query("""SELECT l_orderkey, l_partkey, 'returned' AS origin FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL SELECT l_orderkey, l_partkey, 'other' FROM lineitem WHERE l_returnflag <> 'R'""")
def set_union_all(t: Tables):
    returned = eq("l_returnflag", "R")
    parts = [
        t.lineitem.where(cond).select("l_orderkey", "l_partkey", F.lit(name).alias("origin"))
        for cond, name in [(returned, "returned"), (~returned, "other")]
    ]
    return parts[0].unionByName(parts[1])


@query("""WITH latest AS (
        SELECT user_id * 20 AS id, event_type AS state FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT id, state FROM latest
    UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT id FROM latest)""")
def merge_increment(t: Tables):
    old = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("state"))
    new = t.events.select((F.col("user_id") * 20).alias("id"), F.col("event_type").alias("state"),
                          "ts", "event_id")
    return merge(old, new, ["id"], ["ts"], ["event_id"])


# Audits


@query(f"""WITH {DAILY}
    SELECT 'finished_orders' AS table_name, count(*) AS record_count FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'live_customers', count(*) FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'lines_today', count(*) FROM daily WHERE ds = '19980630'
    UNION ALL SELECT 'lines_last_week', count(*) FROM daily WHERE ds BETWEEN '19980623' AND '19980629'""")
def audit_source_counts(t: Tables):
    return audit_sources({
        "finished_orders": t.orders.where(eq("o_orderstatus", "F")),
        "live_customers": t.customer.where(F.col("c_acctbal") > 0),
        "lines_today": snapshot(t.daily, RUN.ds),
        "lines_last_week": trailing_days(t.daily, RUN, 7),
    })


@query(f"WITH {DAILY} SELECT count(*) AS final_count FROM daily WHERE ds = '19980630'")
def audit_result_count(t: Tables):
    return audit_result(t.daily, RUN.ds)


@query("""SELECT count(*) FILTER (l_partkey IS NULL) AS null_l_partkey_count,
                 count(*) FILTER (l_linenumber IS NULL) AS null_l_linenumber_count
          FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def audit_null_count(t: Tables):
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return audit_nulls(rows, ["l_partkey", "l_linenumber"])


@query(f"WITH {DAILY} SELECT ds, count(*) AS daily_count FROM daily GROUP BY ds ORDER BY ds DESC LIMIT 10")
def audit_daily_trend(t: Tables):
    return audit_trend(t.daily, 10)


@query("""SELECT l_orderkey, count(*) AS cnt FROM lineitem GROUP BY l_orderkey
          ORDER BY cnt DESC, l_orderkey LIMIT 10""")
def audit_skew(t: Tables):
    return heaviest_keys(t.lineitem, "l_orderkey", 10)


@query(f"WITH {DAILY} SELECT ds, count(*) AS cnt FROM daily GROUP BY ds")
def audit_partition_counts(t: Tables):
    return audit_partitions(t.daily)


@query("""SELECT l_orderkey, l_partkey, l_returnflag, count(*) AS cnt FROM lineitem
          GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t: Tables):
    return keys_repeated(t.lineitem, TRIPLE)
