"""Shared folders for tables that several jobs read.

A staged table is written once and read back, which cuts its lineage and lets
later readers prune columns. It lies in the folder the cluster names in
`spark.checkpoint.dir`, so it outlives any executor. What is staged inside
`run_folder` is removed when the run ends; other staged tables stay until the
folder is cleared, as results may still be read from them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_run: ContextVar[str | None] = ContextVar("run_folder", default=None)
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`.

    In local mode, where driver and executors share one disk, a temporary
    folder of the application is used when there is none; on a cluster the
    setting is required. The session is left as it is.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="chattermark-")
    return _local[application]


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder of its own, under that of the run or else the shared one."""
    return f"{_run.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store Spark writes to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def run_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder that holds what is staged in the block, and goes with its end or failure."""
    path = new_folder(spark, name)
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        remove(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    return stage_at(df, new_folder(df.sparkSession, name))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    """Write a table to a folder of the caller's and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
