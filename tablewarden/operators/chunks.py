"""A backup store in which snapshots share chunks of rows.

Rows in key order are cut into chunks where the hash of a key says so, so an inserted, changed or
deleted row touches one chunk, or two where it was a cut itself. A chunk is named by its content
and stored once, however many snapshots hold it.

Folders of a store: ``parts`` (rows with the name of their chunk), ``index`` (chunks of each
part), ``manifest`` (chunks of each snapshot). Each is written by one job and counts only when
it is complete; the manifest comes last, so a snapshot exists as a whole or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewarden.functions.columns import canonical_row
from tablewarden.functions.digests import key_bucket, row_digest
from tablewarden.operators.lookup import broadcast_if_small
from tablewarden.operators.ordered import MAX_GROUP_ROWS, MAX_SLICES, sort_columns
from tablewarden.storage import delete_path, materialize, path_exists

ROWS_PER_CHUNK = 1024
_INDEX = "chunk_id string, rows bigint, part string"
_MANIFEST = "chunk_id string, rows bigint, snapshot string"


def _half(digest, start: int):
    """Sixty bits of a digest as a number."""
    return F.conv(F.substr(digest, F.lit(start), F.lit(15)), 16, 10).cast("bigint")


def _key_hash(keys: Sequence[str]):
    return F.unhex(F.md5(canonical_row(keys)))


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a slice in key order in; with the number of cuts up to each row and the key of the last out."""
    cuts, last = 0, None
    for batch in batches:
        key, cut = batch.column("_key"), np.asarray(batch.column("_cut").fill_null(False))
        at = np.maximum.accumulate(np.where(cut, np.arange(len(cut)), -1))
        first = key.take(pa.array(at, pa.int64(), mask=at < 0))
        if last is not None:
            first = first.fill_null(last)
        nth = cuts + np.cumsum(cut)
        if len(cut):
            cuts, last = int(nth[-1]), first[-1] if first[-1].is_valid else None
        yield pa.RecordBatch.from_arrays([key, *[batch.column(c) for c in ("_a", "_b", "_slice")],
                                          pa.array(nth, pa.int64()), first], ["_key", "_a", "_b", "_slice", "_nth", "_first"])


def chunk_keys(df: DataFrame, keys: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK,
               max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Per row: the hash of its key, two halves of the digest of its columns, the first key of its chunk.

    Rows before the first cut have NULL as first key. Rows of one key are never parted, and the
    order of equal keys does not matter. A table is cut in slices of the key order, of about ``max_rows`` / 2 rows
    at most; a row is moved once, to its slice, and stored. What passes between slices is one hash each.
    """
    spark = df.sparkSession
    hashed = df.select(*keys, _key_hash(keys).alias("_key"), row_digest(sorted(df.columns)).alias("_digest"),
                       (key_bucket(keys, rows_per_chunk) == 0).alias("_cut"))
    order = sort_columns(keys)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if max_rows is not None:
        slices = max(slices, min(MAX_SLICES, -(-2 * df.count() // max_rows)))
    laid = (hashed.withColumns({"_a": _half("_digest", 1), "_b": _half("_digest", 16)}).drop("_digest")
            .repartitionByRange(slices, *order).sortWithinPartitions(*order)
            .select("_key", "_a", "_b", "_cut", F.spark_partition_id().alias("_slice")))
    stored = materialize(laid.mapInArrow(
        _cut_batches, "_key binary, _a bigint, _b bigint, _slice int, _nth bigint, _first binary"), "chunk_keys")
    # One row per slice.
    ends = stored.groupBy("_slice").agg(F.max_by("_first", "_nth").alias("_end"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialize(ends.select("_slice", F.last("_end", ignorenulls=True).over(before).alias("_carried")), "carried")
    return stored.join(F.broadcast(carried), "_slice", "left").select(
        "_key", "_a", "_b", F.coalesce("_first", "_carried").alias("_first"))


def _named(keyed: DataFrame) -> DataFrame:
    """Chunks by their first key: rows and content name, from exact sums that are merged map-side."""
    return (keyed.groupBy("_first")
            .agg(F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("_a", "_b")])
            .select("_first", "rows", F.sha2(F.concat_ws(
                ":", F.col("rows").cast("string"), F.col("_a").cast("string"),
                F.col("_b").cast("string")), 256).alias("chunk_id")))


def chunks(df: DataFrame, keys: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK,
           max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """``chunk_id`` and ``rows`` of the chunks of a table."""
    return _named(chunk_keys(df, keys, rows_per_chunk, max_rows)).select("chunk_id", "rows")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _complete(spark: SparkSession, path: str, snapshot: str) -> bool:
    return path_exists(spark, f"{path}/manifest/snapshot={snapshot}/_SUCCESS")


def index(spark: SparkSession, path: str) -> DataFrame:
    """Where each stored chunk is: ``chunk_id``, ``rows``, ``part``.

    A chunk that stands in two parts, as after a sweep that was broken off, is read from one.
    """
    return (_read(spark, f"{path}/index", _INDEX).groupBy("chunk_id")
            .agg(F.first("rows").alias("rows"), F.min("part").alias("part")))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of every snapshot: ``snapshot``, ``chunk_id``, ``rows``."""
    return _read(spark, f"{path}/manifest", _MANIFEST)


def add_snapshot(df: DataFrame, path: str, keys: Sequence[str], snapshot: str,
                 rows_per_chunk: int = ROWS_PER_CHUNK, max_rows: int | None = MAX_GROUP_ROWS
                 ) -> DataFrame:
    """Store the chunks of ``df`` that the store lacks, then the snapshot's manifest; return it.

    ``df`` is read twice and has to give the same rows both times. What is laid aside is a hash and two numbers
    per row, not the table. Only rows of new chunks are moved; the table itself is filtered by
    their keys, which Spark broadcasts while few. Equal rows are kept as often as they occur. A
    snapshot that is there already is an error; an attempt that failed can be repeated.
    """
    spark = df.sparkSession
    if _complete(spark, path, snapshot):
        raise ValueError(f"snapshot {snapshot} is in the store already")
    if clash := {"chunk_id", "part"} & set(df.columns):
        raise ValueError(f"columns with names of the store: {sorted(clash)}")
    keyed = chunk_keys(df, keys, rows_per_chunk, max_rows)
    named = materialize(_named(keyed), "chunks")
    new = named.join(index(spark, path), "chunk_id", "left_anti")
    part = f"p{uuid.uuid4().hex}"
    # A key is in one chunk, whose name travels as bytes.
    names = new.select("_first", F.unhex("chunk_id").alias("_chunk"))
    wanted = (keyed.join(names, keyed["_first"].eqNullSafe(names["_first"]))
              .select("_key", "_chunk").dropDuplicates(["_key"]))
    rows = df.withColumn("_key", _key_hash(keys)).join(wanted, "_key").drop("_key")
    _named_rows(rows.hint("rebalance", "_chunk")).write.parquet(f"{path}/parts/part={part}")
    new.select("chunk_id", "rows").write.parquet(f"{path}/index/part={part}")
    named.select("chunk_id", "rows").write.mode("overwrite").parquet(
        f"{path}/manifest/snapshot={snapshot}")
    return manifest(spark, path).where(F.col("snapshot") == snapshot)


def _named_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("chunk_id", F.lower(F.hex("_chunk"))).drop("_chunk")


def read_snapshot(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    """The rows of a snapshot; only parts that hold chunks of it have matching rows."""
    if not _complete(spark, path, snapshot):
        raise ValueError(f"no snapshot {snapshot} in the store")
    needed = (manifest(spark, path).where(F.col("snapshot") == snapshot)
              .join(index(spark, path), "chunk_id").select(F.unhex("chunk_id").alias("_chunk"), "part"))
    return (_parts(spark, path).join(broadcast_if_small(materialize(needed, "needed")),
                                     ["_chunk", "part"], "left_semi")
            .drop("_chunk", "part"))


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with their part and the name of their chunk as bytes, half as long as its text."""
    return spark.read.parquet(f"{path}/parts").withColumn("_chunk", F.unhex("chunk_id")).drop("chunk_id")


def references(spark: SparkSession, path: str) -> DataFrame:
    """``chunk_id``, ``rows``, ``part`` of each stored chunk and the number of snapshots with it."""
    held = manifest(spark, path).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("snapshots"))
    return (index(spark, path).join(held, "chunk_id", "left")
            .withColumn("snapshots", F.coalesce("snapshots", F.lit(0))))


def expire(spark: SparkSession, path: str, snapshots: Iterable[str]) -> None:
    """Let snapshots go. Their rows stay until ``sweep``."""
    for snapshot in snapshots:
        delete_path(spark, f"{path}/manifest/snapshot={snapshot}")


def sweep(spark: SparkSession, path: str, dead_share: float = 0.2) -> DataFrame:
    """Remove chunks that no snapshot holds, from parts whose rows are dead to ``dead_share`` or more.

    Returns what was done: ``part``, ``rows``, ``dead_rows``, one row per part, as many as additions.
    The live rows of such parts go to one new part; the old ones are removed
    once it is complete. No snapshot may be added meanwhile.
    """
    live = materialize(references(spark, path).where("snapshots > 0")
                       .select("chunk_id", "rows", "part"), "live_chunks")
    listed = _read(spark, f"{path}/index", _INDEX)
    alive = live.select("chunk_id", "part", F.lit(True).alias("_alive"))
    dead = F.sum(F.when(F.col("_alive").isNull(), F.col("rows")).otherwise(0))
    worn = materialize(listed.join(alive, ["chunk_id", "part"], "left")
                       .groupBy("part").agg(F.sum("rows").alias("rows"), dead.alias("dead_rows"))
                       .where((F.col("dead_rows") > 0)
                              & (F.col("dead_rows") >= dead_share * F.col("rows"))), "worn_parts")
    names = [r[0] for r in worn.select("part").collect()]  # at most one per addition
    if names:
        moved = live.where(F.col("part").isin(names))
        part = f"p{uuid.uuid4().hex}"
        kept = (_parts(spark, path).where(F.col("part").isin(names))
                .join(moved.select(F.unhex("chunk_id").alias("_chunk"), "part"), ["_chunk", "part"], "left_semi"))
        _named_rows(kept.drop("part").hint("rebalance", "_chunk")).write.parquet(f"{path}/parts/part={part}")
        moved.select("chunk_id", "rows").write.parquet(f"{path}/index/part={part}")
        for name in names:
            delete_path(spark, f"{path}/index/part={name}")
            delete_path(spark, f"{path}/parts/part={name}")
    return worn
