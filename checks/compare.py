"""Run queries beside their SQL and compare: `python -m checks.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path
from typing import Any

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def plain(value: Any) -> Any:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows(columns: list[str], data: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, build, sql: str, sf_dir: str) -> tuple[str, int]:
    """An empty text if both sides agree, and the number of rows."""
    df = build(spark, sf_dir)
    ours = rows(df.columns, df.collect())
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", ours.total()
    if ours != theirs:
        only, missing = ours - theirs, theirs - ours
        return (f"{ours.total()} rows, expected {theirs.total()}; extra {list(only.items())[:2]}; "
                f"missing {list(missing.items())[:2]}"), ours.total()
    return "", ours.total()


def main(argv: list[str]) -> int:
    from checks import ORACLES, QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").appName("compare")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem, n = compare(spark, db, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {n} rows {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
