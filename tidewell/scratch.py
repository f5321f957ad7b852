"""Shared scratch folders for checkpoints and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Whether shuffle files go with the query that wrote them, not with the driver's next garbage collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders made for local masters without the setting, by application.
_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="tidewell-")
    return _LOCAL[application]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path (not created) below the shared root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, computed now and only once."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, each query's shuffle files are deleted when the query ends: for steps that write all they keep."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; a missing one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, without hidden files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in found]
    return sorted(n for n in names if not n.startswith(("_", ".")))
