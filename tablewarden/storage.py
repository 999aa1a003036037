"""Shared scratch folder: where intermediate tables and stream checkpoints live.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local
session, where that is unset, gets a temporary folder of its own, which goes when Python ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tablewarden-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later uses see the same rows.

    Needed where the rows depend on how they were partitioned, and where a table is
    read several times; the written files outlive the executors that made them.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def _located(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store Spark reaches."""
    path, store = _located(spark, path)
    return store.exists(path)


def delete_path(spark: SparkSession, path: str) -> None:
    path, store = _located(spark, path)
    store.delete(path, True)


def release(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` returned and that nothing reads any more."""
    for table in tables:
        _made.remove(table.stored_at)
        delete_path(table.sparkSession, table.stored_at)


def discard(spark: SparkSession) -> None:
    """Remove the intermediate files that this process has written so far.

    A DataFrame may read them until its result is stored, so this is for the caller of the
    operators, after a result has been written; paths of other processes are not touched.
    """
    while _made:
        delete_path(spark, _made.pop())
