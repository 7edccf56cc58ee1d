"""Intermediate tables that survive the loss of executors.

A lineage is cut by writing Parquet below the folder that the cluster names in
``spark.checkpoint.dir`` (shared by all executors) and reading it back.  Only when
that setting is absent, as in tests on one machine, is a folder made here.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session, or one temp folder where driver and executors are one process."""
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", conf.get("spark.master", "local")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="tidebook-"))
    return _own[0]


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, at = _at(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and return it as a scan of that table.

    The files go when the application ends, or with :func:`release`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name) + "/table"
    df.write.mode("error").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes the files of materialized tables that nothing will read any more."""
    for t in tables:
        fs, at = _at(t.sparkSession, t._written_at)
        fs.delete(at, True)
