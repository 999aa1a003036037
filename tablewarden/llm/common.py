"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.lookup import broadcast_if_small
from tablewarden.storage import materialize

__all__ = ["Packed", "in_blocks", "in_small_batches", "let", "running", "text_key", "key_hex",
           "semi_join_stored", "materialize"]


class Packed:
    """A table whose columns are renamed, so that no name of an operator's own can clash.

    ``df`` has the columns ``_c0, _c1, ...``; ``named`` gives one of them by its old name, and
    ``unpack`` restores the names. A result column replaces an old column of the same name
    (as Spark compares names, without case).
    """

    def __init__(self, df: DataFrame):
        self.names = list(df.columns)
        self.df = df.toDF(*[f"_c{i}" for i in range(len(self.names))])

    def named(self, name: str) -> str:
        for i, n in enumerate(self.names):
            if n.lower() == name.lower():
                return f"_c{i}"
        raise ValueError(f"no column {name} among {self.names}")

    def unpack(self, df: DataFrame, results: Sequence[Column] = (), names: Sequence[str] = ()
               ) -> DataFrame:
        """The old columns of ``df``, then ``results`` under ``names``."""
        new = {n.lower() for n in names}
        return df.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(self.names)
                           if n.lower() not in new],
                         *[c.alias(n) for c, n in zip(results, names, strict=True)])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def in_blocks(values: Column) -> Column:
    """A non-empty array cut into about as many blocks as a block has values."""
    def cut(v: Column) -> Column:
        n = F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / n).cast("int")),
                           lambda i: F.slice(v, i * n + 1, n))
    return let(values, cut)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running values of a non-empty array of numbers from 0 on, such as sums or maxima, which are
    the same in any grouping.

    An array grows by a copy at each step, so values run within blocks, and blocks by their totals.
    """
    def steps(block: Column, first: Column) -> Column:
        return F.aggregate(block, F.array(first), lambda made, x: F.array_append(
            made, combine(F.element_at(made, -1), x)))

    def all_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), combine))
        starts = F.slice(steps(totals, F.lit(0)), 1, F.size(blocks))
        return F.flatten(F.zip_with(blocks, starts, lambda b, first: F.slice(
            steps(b, first), 2, F.size(b))))
    return let(in_blocks(values), all_blocks)


def text_key(text: str | Column) -> Column:
    """16 bytes of SHA-256 that stand for a text; NULL for a NULL text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def key_hex(key: str | Column) -> Column:
    return F.lower(F.hex(key))


# Rows in an Arrow batch of texts. Spark bounds batches by rows only, and its buffers grow with the
# largest batch, so this is what bounds a task's memory when texts are long.
BATCH_ROWS = 256
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of its session limited to ``BATCH_ROWS`` rows.

    Spark reads the limit when a plan runs, so it stays lowered; results do not depend on it.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, BATCH_ROWS)
    return df


def semi_join_stored(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is among the stored ``keys`` (one column, distinct).

    ``keys`` is a stored table, so measuring it is cheap: it is broadcast when it is small,
    and joined by shuffle otherwise.
    """
    return df.join(broadcast_if_small(keys), on, "left_semi")
