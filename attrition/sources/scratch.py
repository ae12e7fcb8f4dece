"""Reliable intermediate storage in the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None
_made: list[str] = []


def shared_base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session without that setting gets
    a folder of its own; on a cluster a missing setting is an error."""
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="attrition-")
    return _local_base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder path below the shared base."""
    path = f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_shared_dirs(spark: SparkSession) -> int:
    """Remove the folders that this process has had made, once nothing reads them any more: call it
    when the results are written. Returns how many there were."""
    removed = 0
    while _made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        removed += bool(store.delete(folder, True))
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs read the written data, also after an executor is lost. With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark removes it when it is no longer used."""
    spark = df.sparkSession
    base = shared_base(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint(eager=True)


@contextmanager
def pinned(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` for the jobs inside the block. Lost blocks are recomputed from lineage."""
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
