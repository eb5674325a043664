import json

import pytest

from conftest import got
from dayledger.__main__ import main
from dayledger.plans.schemas import REWARD_LOG
from dayledger.settings import RECOMMENDED, apply_settings, scan_bytes, shuffle_parts


@pytest.fixture(autouse=True)
def settings_restored(spark):
    keys = [*RECOMMENDED, "spark.sql.shuffle.partitions"]
    before = {k: spark.conf.get(k, None) for k in keys}
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_job_from_the_command_line(spark, tmp_path):
    """Sources as ORC paths, today's target read as tomorrow's snapshot."""
    cols = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in REWARD_LOG.schema if f.name != "id"]
    for role, ids, ds in [("snapshot", "(1), (2)", "20240314"), ("increment", "(2), (3)", "20240315")]:
        df = spark.sql(f"SELECT CAST(id AS BIGINT) AS id, {', '.join(cols)}, '{ds}' AS ds FROM VALUES {ids} AS t(id)")
        df.write.format("orc").partitionBy("ds").save(str(tmp_path / role))
    tables = tmp_path / "tables.json"
    tables.write_text(json.dumps({
        "reward_snapshot": str(tmp_path / "snapshot"), "reward_increment": str(tmp_path / "increment")}))
    main(["reward_merge", "20240315", "--tables", str(tables), "--into", "merged_log"])
    assert got(spark.table("merged_log"), "id", "ds") == [(n, "20240315") for n in (1, 2, 3)]
    spark.sql("DROP TABLE merged_log")


@pytest.mark.parametrize("argv", [["no_such_job", "20240315"], ["reward_merge", "2024-03-15"]])
def test_bad_arguments(argv, tmp_path):
    with pytest.raises(SystemExit):
        main([*argv, "--tables", str(tmp_path / "t.json")])


def test_shuffle_parts():
    assert shuffle_parts(0) == 200
    assert shuffle_parts(2**40) == 8192
    assert shuffle_parts(100 * 2**40) == 819_200  # parts stay of one size


def test_scan_bytes_are_those_of_the_day(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.range(200_000).selectExpr("id", "if(id % 10 = 0, '20240101', '20240102') AS ds").write.partitionBy("ds").parquet(path)
    df = spark.read.schema("id long, ds string").parquet(path)
    assert 0 < scan_bytes(df, "20240101") < scan_bytes(df, "20240102") < scan_bytes(df, "no day")
    assert scan_bytes(spark.range(3), "20240101") == 0


def test_settings(spark):
    apply_settings(spark, shuffle_bytes=2**40)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    apply_settings(spark, **{"spark.sql.shuffle.partitions": "7"})
    assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
