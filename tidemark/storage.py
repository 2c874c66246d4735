"""Shared-folder tables that cut lineage.

The folder is the one the session names in ``spark.checkpoint.dir``. Like
checkpoint files, tables written here are left for the owner of that folder
to expire.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_temporary: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; only in local mode a temporary one, which goes when Python ends."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    run = spark.sparkContext.applicationId
    if run not in _temporary:
        _temporary[run] = tempfile.TemporaryDirectory(prefix="tidemark-", ignore_cleanup_errors=True)
    return _temporary[run].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other call returns."""
    return f"{shared_folder(spark).rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back, so later uses do not recompute it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths of what lies in a folder, sorted; none if it is absent."""
    at, system = _file_system(spark, path)
    if not system.exists(at):
        return []
    return sorted(f"{path.rstrip('/')}/{status.getPath().getName()}" for status in system.listStatus(at))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with asterisks."""
    at, system = _file_system(spark, pattern)
    return sorted(str(status.getPath()) for status in system.globStatus(at) or [])


def remove(spark: SparkSession, path: str) -> None:
    at, system = _file_system(spark, path)
    system.delete(at, True)
