"""Run one day of a job: `spark-submit` or `python -m dayledger JOB DS --tables tables.json`.

The JSON file maps each role the job reads to a table name or a path.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from dayledger.plans import JOBS, run_job
from dayledger.rundate import RunDate
from dayledger.settings import apply_settings, scan_bytes
from dayledger.sources import Catalog

UNPACKED = 4  # bytes in a shuffle to a byte of a compressed column file, about


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="dayledger", description="Run one day of a job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("ds", type=RunDate.parse, help="run date, yyyyMMdd")
    parser.add_argument("--tables", type=Path, required=True, help="JSON file: role -> table or path")
    parser.add_argument("--format", default="orc", help="file format of roles given as paths")
    target = parser.add_mutually_exclusive_group()
    target.add_argument("--into", help="target table; by default the job's own name for it")
    target.add_argument("--path", help="target directory instead of a table")
    parser.add_argument("--append", action="store_true", help="add to the day instead of replacing it")
    parser.add_argument("--token", help="name of the run, the same when it is tried again, where days are made of runs")
    parser.add_argument("--shuffle-gb", type=float, help="size of the job's largest shuffle; by default told from its largest table's day")
    parser.add_argument("--time-zone", help="zone of days and months, where the session has none set")
    parser.add_argument("--expire", action="store_true", help="drop days past the retention afterwards")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"{args.job} {args.ds.ds}").getOrCreate()
    catalog = Catalog(spark, json.loads(args.tables.read_text()), args.format)
    if args.shuffle_gb is None:
        sizes = [scan_bytes(catalog.table(role), args.ds.ds) for role in catalog.tables]
        shuffled = UNPACKED * max(sizes, default=0)
    else:
        shuffled = int(args.shuffle_gb * 2**30)
    apply_settings(spark, shuffled)
    if args.time_zone:
        spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    spec = JOBS[args.job].spec
    spec = spec.named(args.into) if args.into else spec
    run_job(args.job, catalog, args.ds, spec, args.path, args.append, args.expire, args.token)


if __name__ == "__main__":
    main()
