"""Intermediate results that several readers share, or whose partitions must not change.

They are written as parquet into the shared folder the session names in ``spark.checkpoint.dir``.
A lost executor then costs a re-read, not a recomputation, and later readers still get column
pruning, filter pushdown and true sizes for the broadcast decision.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate results; only a local session may fall back to a temporary one."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if "folder" not in _local:
        _local["folder"] = tempfile.mkdtemp(prefix="daybook-")
        atexit.register(shutil.rmtree, _local["folder"], ignore_errors=True)
    return _local["folder"]


def fresh_path(spark: SparkSession) -> str:
    """A folder below the shared one that nothing uses yet."""
    return f"{shared_folder(spark)}/daybook-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end; else these stay until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back; what it was shuffled for is not kept."""
    path = path or fresh_path(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate result that no later step reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``; none if it does not exist."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []
