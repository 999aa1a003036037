"""Joins against a smaller table, with the size checked before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.storage import materialize

MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: eight per value, and the text of everything that is not fixed-size."""
    total = F.lit(8 * len(df.columns)).cast("bigint")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(field.name))
            total = total + F.coalesce(F.octet_length(text), F.lit(0))
    return total


def table_bytes(df: DataFrame) -> int:
    """Size of the rows, from one aggregate."""
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring it; larger tables stay unmarked.

    An unmarked side is joined by shuffle, where adaptive execution splits skewed
    partitions of the other side.
    """
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
                measure: bool = False, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join with a smaller table.

    ``measure`` is for a small side that is read from files: it costs one aggregate over them
    and allows a broadcast. Measuring a derived side would compute it twice, so that one is
    left to Spark, which decides from the file sizes or from the shuffled size.
    """
    return big.join(broadcast_if_small(small, max_bytes) if measure else small, list(on), how)


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], salts: int = 16,
                how: str = "inner", hot_share: float = 0.001, hot_rows: int | None = None
                ) -> DataFrame:
    """Equi-join that spreads hot keys over ``salts`` tasks.

    A key is hot with more than ``hot_share`` of the rows, which bounds the broadcast list of
    hot keys at any size; ``hot_rows`` sets a number of rows instead.

    Only rows of hot keys are salted in ``big`` and repeated in ``small``. The salt is a
    hash of the whole row plus its input partition, so a retried task repeats it and equal
    copies still spread.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting repeats the right side, so {how} is not possible")
    on = list(on)
    keyed = F.lit(True)
    for c in on:
        keyed = keyed & F.col(c).isNotNull()
    counts = big.where(keyed).groupBy(*on).count()
    least = F.lit(hot_rows) if hot_rows is not None else (
        F.greatest(F.lit(1), counts.agg(F.sum("count")).scalar() * hot_share))
    # At most (rows of big / hot_rows) keys, or (1 / hot_share) keys.
    hot = materialize(counts.where(F.col("count") > least)
                      .select(*on, F.lit(True).alias("_hot")), "hot_keys")
    row = F.pmod(F.xxhash64(*big.columns), F.lit(salts))
    spread = F.pmod(row + F.spark_partition_id(), F.lit(salts)).cast("int")
    # A row with a NULL key matches nothing, so it may go to any task.
    left = (big.withColumn("_spread", spread).join(F.broadcast(hot), on, "left")
            .withColumn("_salt", F.when(F.col("_hot") | ~keyed, F.col("_spread")).otherwise(0))
            .drop("_spread", "_hot"))
    right = (small.join(F.broadcast(hot), on, "left")
             .withColumn("_salt", F.explode(F.sequence(
                 F.lit(0), F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(0))))
             .drop("_hot"))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
