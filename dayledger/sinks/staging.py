"""Intermediate results written out: they cut a long plan, and survive lost executors."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}  # by application


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by `spark.checkpoint.dir`. Where that is unset, a local
    session gets a temporary folder and a cluster session an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="dayledger-")
    return _local_dirs[app]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the result under a fresh name in the shared folder and read it back. The files stay."""
    return _write(df, fresh_path(df.sparkSession, name))


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`stage`, with the rows removed at the end: an empty file takes the place of theirs. Write or
    collect what reads them before that."""
    path = fresh_path(df.sparkSession, name)
    try:
        yield _write(df, path)
    finally:
        df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
