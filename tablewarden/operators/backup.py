"""Backup and recovery of tables: snapshots, differences, change sets, restore, digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.digests import digest_aggregates, key_bucket, row_digest
from tablewarden.operators.loading import apply_changes, upsert


def snapshot(df: DataFrame, path: str, snapshot_id: str) -> DataFrame:
    """Write a full copy to its own folder and add its rows and digest to the manifest.

    The digest is taken from the written files, so it vouches for the copy and not for the
    source; ``verify`` compares the two.
    """
    spark = df.sparkSession
    df.write.parquet(f"{path}/data/{snapshot_id}")
    entry = (digest(read_snapshot(spark, path, snapshot_id))
             .select(F.lit(snapshot_id).alias("snapshot_id"), "rows", "xor48", "sum32"))
    entry.write.mode("append").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_snapshot(spark: SparkSession, path: str, snapshot_id: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data/{snapshot_id}")


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows between two versions with unique keys.

    ``op`` is I, U or D; ``before`` and ``after`` hold the other columns. Values compare
    NULL-safe.
    """
    keys = list(keys)
    attributes = [c for c in new.columns if c not in keys]
    a = old.select(*keys, F.struct(*attributes).alias("before"))
    b = new.select(*keys, F.struct(*attributes).alias("after"))
    op = (F.when(F.col("before").isNull(), "I").when(F.col("after").isNull(), "D").otherwise("U"))
    return (a.join(b, keys, "full_outer")
            .where(~F.col("before").eqNullSafe(F.col("after")))
            .select(*keys, op.alias("op"), "before", "after"))


def change_set(base: DataFrame, new: DataFrame, keys: Sequence[str], set_id: str, seq: int,
               kind: str) -> DataFrame:
    """What leads from ``base`` to ``new``: an increment (INCR) or a differential (DIFF).

    Deleted rows keep their key and have NULL elsewhere. ``seq`` orders the sets.
    """
    return diff(base, new, keys).select(
        *keys, "after.*", "op", F.lit(set_id).alias("set_id"), F.lit(seq).alias("seq"),
        F.lit(kind).alias("kind"))


def restore(full: DataFrame, sets: DataFrame, keys: Sequence[str], upto: int) -> DataFrame:
    """State at set ``upto``: the full copy, the newest differential, later increments."""
    reached = sets.where(F.col("seq") <= upto)
    base = F.coalesce(reached.where("kind = 'DIFF'").agg(F.max("seq").alias("s")).scalar(),
                      F.lit(-1))
    needed = reached.where(((F.col("kind") == "DIFF") & (F.col("seq") == base))
                           | ((F.col("kind") == "INCR") & (F.col("seq") > base)))
    return apply_changes(full, needed.drop("set_id", "kind"), keys, "seq")


def digest(df: DataFrame, keys: Sequence[str] = (), buckets: int = 1) -> DataFrame:
    """Order-free digest of the table, or of each key bucket: count, XOR and sum."""
    columns = sorted(df.columns)
    hashed = df.select(row_digest(columns).alias("_digest"),
                       *([key_bucket(keys, buckets).alias("bucket")] if keys else []))
    return hashed.groupBy(*(["bucket"] if keys else [])).agg(*digest_aggregates(F.col("_digest")))


def differing_buckets(a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int = 256
                      ) -> DataFrame:
    """Buckets whose digests differ, with the row counts on both sides."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return digest(df, keys, buckets).select(
            "bucket", F.struct("rows", "xor48", "sum32").alias(name))
    both = side(a, "left").join(side(b, "right"), "bucket", "full_outer")
    return both.where(~F.col("left").eqNullSafe(F.col("right"))).select(
        "bucket", F.coalesce("left.rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right.rows", F.lit(0)).alias("right_rows"))


ROWS_PER_BUCKET = 100_000
MAX_BUCKETS = 1_000_000


def verify(a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Rows that differ between two copies; only differing buckets are joined row by row.

    Without ``buckets`` their number follows from the rows of ``a``, so that a bucket, which is
    what one wrong row costs, holds about ``ROWS_PER_BUCKET`` rows at any size; there are between
    256 and ``MAX_BUCKETS``. The bad buckets are one number each, so they are broadcast.
    """
    if buckets is None:
        buckets = max(256, min(MAX_BUCKETS, a.count() // ROWS_PER_BUCKET))
    bad = F.broadcast(differing_buckets(a, b, keys, buckets).select("bucket"))

    def suspect(df: DataFrame) -> DataFrame:
        return (df.withColumn("bucket", key_bucket(keys, buckets))
                .join(bad, "bucket", "left_semi").drop("bucket"))
    return diff(suspect(a), suspect(b), keys)


def recover_rows(current: DataFrame, snap: DataFrame, keys: Sequence[str],
                 wanted: str | Column) -> DataFrame:
    """Take the rows matching ``wanted`` from a snapshot; keep every other current row."""
    return upsert(current, snap.where(wanted), keys)
