"""Facts on two time axes: when they hold, and since when they are known.

A load says what holds for a key in a period. Later loads overrule earlier ones where their
periods meet, also in the past. The result are rectangles: a value, the time it holds and the time in
which this was believed, as large as they can be made.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.operators.intervals import overlap_join
from tablewarden.operators.ordered import MAX_GROUP_ROWS, arrange, windowed
from tablewarden.storage import materialize

VALID = ("valid_from", "valid_to")
KNOWN = ("known_from", "known_to")


def periods(facts: DataFrame, keys: Sequence[str], values: Sequence[str], known_at: str = "known_at",
            valid: tuple[str, str] = VALID, tie: Sequence[str] = (), ended: str | None = None,
            max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """(keys, values, valid_from, valid_to, known_from, known_to) of the facts, without overlap.

    ``facts`` has a row for each statement: from ``valid[0]`` to before ``valid[1]`` (NULL: for ever)
    the key has the values, known since ``known_at``. For each key, time is cut at all bounds of its periods;
    in a piece each statement is believed until the next one that covers it. Of statements known at the
    same time the largest by ``tie`` counts; with equal ties too, the largest by values. ``ended`` names
    a boolean column: where it is true, the statement says that the key has no values in the period, and
    gives no row. Then neighbours with equal values are put together, first in the time of knowledge,
    then in the time of validity. ``known_to`` is NULL for what is believed now.

    Rows with a NULL key, start or time of knowledge, or a period without points, say nothing. Repeated
    rows change nothing. Work grows with the pieces that statements cover; a key of more than ``max_rows``
    pieces is spread over many tasks. Of an empty table the result is empty.
    """
    start, end = valid
    gone = F.coalesce(F.col(ended), F.lit(False)) if ended else F.lit(False)
    kinds = dict(facts.dtypes)
    stated = facts.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(start).alias("_from"), F.col(end).alias("_to"),
        F.col(known_at).alias("_known"), F.struct(*[F.col(t) for t in tie], gone.alias("_gone"),
                                                  *[F.col(v) for v in values]).alias("_said"),
        F.struct(gone.alias("gone"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]).alias("_value"))
    own = [f"_key{i}" for i in range(len(keys))]
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*own, "_from", "_known"]])
    stated = materialize(stated.where(present & (F.col("_to").isNull() | (F.col("_from") < F.col("_to")))), "statements")
    # The pieces between neighbouring bounds of a key.
    bounds = stated.select(*own, F.col("_from").alias("_at")).unionAll(
        stated.where(F.col("_to").isNotNull()).select(*own, F.col("_to").alias("_at"))).distinct()
    bounds = windowed(bounds, own, ["_at"], {"_next": lambda w: F.lead("_at").over(w)}, 0, 1, max_rows)
    pieces = bounds.select(*[F.col(c).alias(f"_p{c}") for c in own], F.col("_at").alias("_piece"),
                           F.col("_next").alias("_piece_to"))
    covered = overlap_join(stated, pieces, ("_from", "_to"), ("_piece", "_piece_to"), own, [f"_p{c}" for c in own])
    # What a load says last of a piece, then how long it is believed.
    said = covered.groupBy(*own, "_piece", "_piece_to", "_known").agg(F.max_by("_value", "_said").alias("_value"))
    loads = Window.partitionBy(*own, "_piece").orderBy("_known")
    said = said.withColumn("_repeats", F.lag("_value").over(loads).eqNullSafe(F.col("_value")))
    said = said.where(~F.col("_repeats")).withColumn("_until", F.lead("_known").over(loads))
    # Stored, since the groups are counted before they are laid out.
    said = materialize(said.where(~F.col("_value.gone")), "believed")
    # Neighbouring pieces with equal values that were believed in the same time.
    belief = [*own, "_known", "_until", "_value"]
    laid = arrange(said, belief, ["_piece"], max_rows).windowed(
        {"_before": lambda w: F.lag("_piece_to").over(w)}, 1, 0)
    islands = laid.map(lambda d: d.withColumn("_new", F.when(F.col("_before").eqNullSafe(F.col("_piece")), 0).otherwise(1))) \
        .running({"_island": ("sum", "_new")}).rows()
    whole = islands.groupBy(*own, "_known", "_until", "_value", "_island").agg(
        F.min("_piece").alias("_first"),
        F.max(F.struct(F.col("_piece_to").isNull().alias("open"), F.col("_piece_to").alias("to"))).alias("_last"))
    return whole.select(*[F.col(c).alias(k) for c, k in zip(own, keys, strict=True)],
                        *[F.col(f"_value.v{i}").cast(kinds[v]).alias(v) for i, v in enumerate(values)],
                        F.col("_first").alias(VALID[0]), F.col("_last.to").alias(VALID[1]),
                        F.col("_known").alias(KNOWN[0]), F.col("_until").alias(KNOWN[1]))


def state_at(table: DataFrame, valid: Column, known: Column) -> DataFrame:
    """The rows of ``periods`` that held at ``valid`` as it was believed at ``known``."""
    def within(bounds: tuple[str, str], at: Column) -> Column:
        return (F.col(bounds[0]) <= at) & (F.col(bounds[1]).isNull() | (at < F.col(bounds[1])))
    return table.where(within(VALID, valid) & within(KNOWN, known)).drop(*VALID, *KNOWN)
