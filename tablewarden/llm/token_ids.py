"""Token ids as compressed files: one dictionary for all documents, each document on its own.

Documents are encoded and compressed where they lie; only their frames are shuffled, to the task of
their slice of the id order. Files go through Spark's own writer, so an attempt of a task that is
lost leaves nothing behind, and any store that Spark writes to will do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import id_files
from tablewarden.llm.common import in_small_batches
from tablewarden.llm.units import encoder
from tablewarden.storage import new_path

END_ID = 2
DICTIONARY_BYTES = 64 * 1024
# The dictionary is trained on so many texts at most, each of at most so many bytes.
SAMPLE_TEXTS, SAMPLE_TEXT_BYTES = 600, 32 * 1024
# Documents in a slice of the id order, and the most slices; a slice can be many shards.
SLICE_ROWS, MAX_SLICES = 2_000, 10_000


def train_dictionary(docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text",
                     end_id: int | None = END_ID, size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary over the serialized ids of a bounded sample of texts.

    The sample is the ``SAMPLE_TEXTS`` documents with the smallest hash of the id among those of at
    most ``SAMPLE_TEXT_BYTES``. Without such texts the dictionary is empty. It changes the size of
    files only.
    """
    short = docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text")).where(
        F.octet_length("_text") <= SAMPLE_TEXT_BYTES)
    order = [F.xxhash64("_id"), F.col("_id"), F.xxhash64("_text")]
    # Every task sends its first rows to the driver, so these are ids only; then the texts of those come.
    places = short.select(*[c.alias(f"_place{i}") for i, c in enumerate(order)])
    first = places.orderBy(*places.columns).limit(SAMPLE_TEXTS).select(F.col("_place1").alias("_id")).collect()
    named = docs.sparkSession.createDataFrame(sorted({(r._id,) for r in first if r._id is not None}), short.select("_id").schema)
    if len(first) > sum(r._id is not None for r in first):
        named = named.unionAll(named.sparkSession.createDataFrame([(None,)], named.schema))
    named = named.select(F.col("_id").alias("_wanted"))
    sample = short.join(F.broadcast(named), F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi")
    texts = [r._text for r in sample.orderBy(*order).limit(SAMPLE_TEXTS).select("_text").collect()]
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    return id_files.train([ids + end for ids in encoder(tokenizer).encode(texts)], size)


def write_ids(docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text",
              end_id: int | None = END_ID, folder: str | None = None,
              shard_bytes: int = id_files.SHARD_BYTES) -> str:
    """Encode, compress and write all texts in ascending order of ids; returns the folder.

    ``tokenizer`` is the path of a tokenizers file that every executor can read; its special
    tokens are found in texts as the library finds them, and none are added but ``end_id``, which
    ends each document (None: nothing does). A NULL text is an empty one. NULL ids come first;
    rows with equal ids, and repeated rows, are documents of their own that follow one another in an
    order that is fixed when the files are written. ``ident`` is an integer column; other columns
    are not looked at, so their names may be anything. A very long text is one frame. Of an empty
    table there are no shards. ``folder`` must be new; by default it is one in the shared folder.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token_ids")
    table = docs.select(F.col(ident).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    dictionary = train_dictionary(table, tokenizer, "id", "text", end_id)
    digest = id_files.digest_of(dictionary)
    rows, known = table.agg(F.count(F.lit(1)), F.count("id")).first()
    slices = max(1, min(MAX_SLICES, known // SLICE_ROWS))
    shares = [i / slices for i in range(1, slices)]
    found = table.agg(F.percentile_approx("id", shares, 10 * slices)).first()[0] if shares else None
    null_slices = max(1, min(MAX_SLICES, (rows - known) // SLICE_ROWS))
    encoded = in_small_batches(table).mapInArrow(
        partial(id_files.encode_batches, tokenizer=tokenizer, end_id=end_id, dictionary=dictionary,
                bounds=np.array(found or [], np.int64), null_slices=null_slices),
        "slice bigint, id bigint, n_tokens bigint, frame binary")
    laid = encoded.repartition("slice").sortWithinPartitions("slice", F.col("id").asc_nulls_first())
    shards = laid.mapInArrow(
        partial(id_files.shard_batches, digest=digest, shard_bytes=shard_bytes),
        "slice bigint, before bigint, tokens bigint, low bigint, high bigint, shard binary")
    kept = spark.createDataFrame([(digest, dictionary)], "dictionary string, data binary")
    _raw(kept.coalesce(1), "data").write.partitionBy("dictionary").text(f"{folder}/dictionary")
    _raw(shards, "shard").write.partitionBy("slice", "before", "tokens", "low", "high").text(f"{folder}/shards")
    return folder


def _raw(df: DataFrame, data: str) -> DataFrame:
    """The bytes of ``data`` as the text that the writer copies as it is."""
    return df.withColumn(data, F.col(data).cast("string"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    """The dictionary of a folder, after its hash was compared with the one it is stored under."""
    row = _files(spark, f"{folder}/dictionary").select("dictionary", "content").first()
    data = bytes(row.content)[:-1]
    if id_files.digest_of(data) != row.dictionary:
        raise ValueError("the dictionary is damaged")
    return data


def read_ids(spark: SparkSession, folder: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """(id, start, n_tokens, ids) of every document in the files of a folder.

    ``start`` counts the ids of all documents before it, ``ids`` are unsigned 32-bit integers, little
    end first. With ``wanted``, a list of ids, only shards whose range of ids has one of them are
    opened and only the frames of those documents are decompressed; a short document costs no
    more for its neighbours. NULL is never wanted. A folder without shards gives an empty table.
    """
    kinds = "id bigint, start bigint, n_tokens bigint, ids binary"
    shards = _files(spark, f"{folder}/shards")
    if "slice" not in shards.columns:
        return spark.createDataFrame([], kinds)
    # One number per slice, of which there are at most 2 * MAX_SLICES.
    totals = shards.groupBy(F.col("slice").cast("bigint").alias("slice")).agg(
        F.sum(F.col("tokens").cast("bigint")).alias("tokens")).orderBy("slice").collect()
    starts, sum_before = {}, 0
    for r in totals:
        starts[r.slice] = sum_before
        sum_before += r.tokens
    if wanted is not None:
        near = F.lit(False)
        for i in wanted:
            near = near | (F.lit(i) >= F.col("low").cast("bigint")) & (F.lit(i) <= F.col("high").cast("bigint"))
        shards = shards.where(near)
    chosen = shards.select(F.col("slice").cast("bigint"), F.col("before").cast("bigint"), "content")
    return chosen.mapInArrow(
        partial(id_files.read_batches, dictionary=read_dictionary(spark, folder), starts=starts,
                wanted=None if wanted is None else frozenset(wanted)), kinds)
