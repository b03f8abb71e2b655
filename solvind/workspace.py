"""Where intermediate tables go: the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local: tempfile.TemporaryDirectory | None = None
_staged: list[str] = []


def _local_root() -> str:
    global _local
    if _local is None:
        _local = tempfile.TemporaryDirectory(prefix="solvind-", ignore_cleanup_errors=True)
        atexit.register(_local.cleanup)
    return _local.name


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a local folder only when Spark itself runs on one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "local").startswith("local"):
        return _local_root()
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def delete_folders(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Delete folders through Hadoop's file systems; returns how many files went and their bytes."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = {"files": 0, "bytes": 0}
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        system = path.getFileSystem(conf)
        if system.exists(path):
            summary = system.getContentSummary(path)
            gone["files"] += summary.getFileCount()
            gone["bytes"] += summary.getLength()
            system.delete(path, True)
    return gone


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any that matches a glob, is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob, listed by the file system that holds them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [status.getPath().toString() for status in found if status.isDirectory()]


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Staged tables made inside are removed at the end: a job leaves nothing in the shared folder."""
    outer = list(_staged)
    _staged.clear()
    try:
        yield
    finally:
        delete_folders(spark, _staged)
        _staged[:] = outer


def staged_path(spark: SparkSession, label: str) -> str:
    """A fresh path that belongs to the job that runs."""
    _staged.append(fresh_path(spark, label))
    return _staged[-1]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
