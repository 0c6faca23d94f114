"""Cutting lineage through the shared, durable folder of the cluster."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders made inside `scratch`, innermost last.
_OPEN: list[list[str]] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names, or one in the warehouse; never one of a single machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            sc.setCheckpointDir(named)
        else:
            # The warehouse is the other folder that all machines share.
            sc.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/catalith-checkpoints")
    return sc.getCheckpointDir()


def staging_folder(spark: SparkSession) -> str:
    """A fresh folder for the tables of one run."""
    folder = f"{checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(folder)
    return folder


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the staging folders made inside, once all went well: what is kept must be written elsewhere by then."""
    _OPEN.append([])
    try:
        yield
    except BaseException:
        _OPEN.pop()
        raise
    for folder in _OPEN.pop():
        drop_folder(spark, folder)


def stage(df: DataFrame, folder: str, name: str, append: bool = False) -> DataFrame:
    """Write a table used by many later plans once, and read it back.

    Unlike a cached frame it survives lost executors, and later plans prune its
    columns and know its size. What was shuffled for it goes as soon as it is
    written, not when the driver happens to collect its garbage.
    """
    path, conf = f"{folder}/{name}", df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("append" if append else "overwrite").parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, folder: str, *names: str) -> None:
    """Remove staged tables from which nothing more is made; a name may be a pattern."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        for found in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(top, name)) or ():
            store.delete(found.getPath(), True)
