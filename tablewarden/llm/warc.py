"""WARC archives of pages: written with repeated payloads as revisits, read back record by record."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import in_small_batches, materialize
from tablewarden.llm.records import ID_END, ID_PREFIX, read_batches, write_batches
from tablewarden.operators.lookup import broadcast_if_small
from tablewarden.storage import new_path

MAX_READ_TASKS = 10_000


def write_archives(pages: DataFrame, ident: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write one record per page; returns the stored list of archives (path, records, bytes).

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the largest id is
    a response, the others are revisits of it; other pages are responses. A NULL payload is empty.
    A NULL id is smaller than any other; rows that share the largest id, or only have NULL ids,
    are all responses. Only digests are shuffled: a payload goes from the table to its archive.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(ident).cast("bigint").alias("_page"), F.col(url).cast("string").alias("_url"),
                        payload.alias("_html"), F.sha1(payload).alias("_digest"),
                        F.octet_length(payload).alias("_size"))
    repeated = (rows.where(F.col("_size") >= least_bytes).groupBy("_digest", "_size")
                .agg(F.count(F.lit(1)).alias("_n"), F.max("_page").alias("_first"))
                .where(F.col("_n") > 1).select("_digest", "_size", "_first"))
    repeated = materialize(repeated, "repeated_payloads")
    joined = rows.join(broadcast_if_small(repeated), ["_digest", "_size"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_page").eqNullSafe(F.col("_first"))
    target = folder or new_path(spark, "warc")
    records = joined.select("_page", "_url", "_html", F.when(revisit, F.col("_first")), revisit)
    archives = in_small_batches(records).mapInArrow(
        partial(write_batches, folder=target), "path string, records bigint, bytes bigint")
    return materialize(archives, "warc_list")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives in column ``path``, in order within each archive.

    Columns: ``record_id, record_type, target_uri, refers_to, payload_digest, payload_bytes,
    payload`` (NULL for revisits, or without ``payloads``), ``intact``. The size and digest of a
    revisit are those of the payload that it stands for. An archive that is not well formed
    raises an error.
    """
    paths = archives.select("path")
    tasks = max(1, min(MAX_READ_TASKS, paths.count()))
    return paths.repartition(tasks).mapInArrow(
        partial(read_batches, payloads=payloads),
        "record_id string, record_type string, target_uri string, refers_to string, "
        "payload_digest string, payload_bytes bigint, payload binary, intact boolean")


def page_of(record_id: str | Column) -> Column:
    """The page id in a record id; NULL if there is none."""
    column = F.col(record_id) if isinstance(record_id, str) else record_id
    inner = F.substring(column, len(ID_PREFIX) + 1, 40)
    return F.rtrim(inner, F.lit(ID_END)).try_cast("bigint")
