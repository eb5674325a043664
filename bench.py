"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each query is built and
run in full, its checks and detections included, into a sink that drops the rows; the first run
warms up and the better of the next two counts.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from checks import QUERIES
from dayledger.settings import apply_settings

HEADLINE = [
    "job_monthly_apply_count",
    "job_account_apply_detail",
    "job_render_flags",
    "job_order_material_detail",
    "job_order_material_onepass",
    "job_order_material_fallback",
    "job_order_material_three_level",
    "job_order_material_staged",
    "job_merge_increment",
    "job_relation_tags",
    "snapshot_diff",
    "first_per_key_ties",
    "latest_per_key",
    "join_fallback",
    "join_salted",
    "join_star",
    "agg_count_distinct",
    "audit_skew",
    "sink_overwrite_partition",
]


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_settings(spark)
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(2)), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
