"""Writing tables: touched partitions only, whole versions behind a pointer."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, cols: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for; repeatable.

    Rows are gathered by partition value first, so a task writes few files. AQE splits
    the gathered partitions that are too large (a rebalance, not a fixed shuffle).
    """
    (df.hint("rebalance", *cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))


def publish(df: DataFrame, path: str, version: int) -> None:
    """Write a version to a folder of its own, then append the pointer to it.

    A reader sees the old version until the pointer is there. Every attempt has its own
    folder, and a version that has a pointer is left as it is, so nothing is overwritten.
    """
    spark = df.sparkSession
    if version in {r["version"] for r in _pointers(spark, path)}:
        return
    folder = f"version={version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    (spark.range(1).select(F.lit(version).cast("bigint").alias("version"),
                           F.lit(folder).alias("folder"))
     .coalesce(1).write.mode("append").parquet(f"{path}/_pointer"))


def _pointers(spark: SparkSession, path: str) -> list:
    """(version, folder) of all versions: one row per publication."""
    try:
        return spark.read.parquet(f"{path}/_pointer").orderBy("version", "folder").collect()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise


def current_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """The newest version, or the newest one below a number."""
    known = [r["version"] for r in _pointers(spark, path) if below is None or r["version"] < below]
    return max(known, default=None)


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version, the newest one by default."""
    version = current_version(spark, path) if version is None else version
    folders = [r["folder"] for r in _pointers(spark, path) if r["version"] == version]
    if not folders:
        raise ValueError(f"no version {version} at {path}")
    return spark.read.parquet(f"{path}/{folders[0]}")
