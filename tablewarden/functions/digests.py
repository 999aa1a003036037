"""Order-free digests of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewarden.functions.columns import canonical_row


def _hex_slice(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substr(digest, F.lit(start), F.lit(digits)), 16, 10).cast("bigint")


def row_digest(columns: Sequence[str]) -> Column:
    return F.md5(canonical_row(columns))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by its key, the same in every copy of the table."""
    return F.pmod(_hex_slice(F.md5(canonical_row(keys)), 25, 8), F.lit(buckets))


def digest_aggregates(digest: Column) -> list[Column]:
    """Row count, XOR over 48 bits and sum over other 32 bits.

    XOR alone cancels pairs of equal rows; count and sum catch those.
    """
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(_hex_slice(digest, 1, 12)), F.lit(0)).alias("xor48"),
        F.coalesce(F.sum(_hex_slice(digest, 17, 8).cast("decimal(20,0)")), F.lit(0))
        .cast("string").alias("sum32"),
    ]
