"""Overlap join of two tables of intervals, without comparing intervals that lie apart.

Time is cut into bins, bins into ever coarser ones. An interval belongs to the size of bins that its length is
like, where it touches three bins at most; in coarser sizes it visits the bin or two that it touches, if the other
table has intervals there. Two intervals meet in the size of the longer one, in the bin of the later start, so the
join is an equi-join on the bin that finds each pair once, and what shares a bin lies no further
apart than an interval of that size is long. Keys with few rows need no bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators.lookup import broadcast_if_small
from tablewarden.storage import materialize

# Bins of one size in a bin of the next.
FAN = 4
# Rows of a key in a table up to which every two are compared.
SMALL_GROUP = 256
_WIDEST = 1 << 62


def as_number(df: DataFrame, name: str) -> Column:
    """A date, timestamp or integer as a bigint: days, microseconds or itself."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    raise ValueError(f"{name} is neither an integer nor a date nor a timestamp")


def _prepared(df: DataFrame, bounds: tuple[str, str], on: Sequence[str], side: str) -> DataFrame:
    """Stored (keys, bounds as numbers, row) of the intervals that can overlap anything."""
    start, end = (as_number(df, b) for b in bounds)
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)], start.alias("_start"),
                     F.coalesce(end, F.lit(_WIDEST)).alias("_end"), F.struct(*df.columns).alias(side))
    for i in range(len(on)):
        rows = rows.where(F.col(f"_k{i}").isNotNull())
    return materialize(rows.where(F.col("_start") < F.col("_end")), "intervals")


def _limits(rows: DataFrame) -> tuple:
    return tuple(rows.agg(F.count(F.lit(1)), F.min("_start"), F.max("_start")).first())


def _crowded(one: DataFrame, two: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Stored keys with more than ``SMALL_GROUP`` rows in a table, or None; at most rows / SMALL_GROUP."""
    def of(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SMALL_GROUP).select(*keys)
    crowded = materialize(of(one).unionAll(of(two)).distinct(), "crowded_keys")
    return None if crowded.isEmpty() else crowded


def _div(c: Column, size: int) -> Column:
    """Integer quotient of numbers that are not negative."""
    return F.call_function("div", c, F.lit(size).cast("bigint"))


def _places(placed: Sequence[tuple[Column, int, int]], first: Column, last: Column, width: int) -> Column:
    """Bins from the one of ``first`` to the one of ``last``, for each (condition, level, pairing)."""
    none = F.array().cast("array<struct<level:int,bin:bigint,pairing:int,opens:boolean>>")

    def bins(level: int, pairing: int) -> Column:
        low, high = _div(first, width * FAN**level), _div(last, width * FAN**level)
        return F.transform(F.sequence(low, high), lambda b: F.struct(
            F.lit(level).alias("level"), b.alias("bin"), F.lit(pairing).alias("pairing"), (b == low).alias("opens")))
    return F.concat(none, *[F.when(cond, bins(level, pairing)).otherwise(none) for cond, level, pairing in placed])


def overlap_join(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str],
                 left_on: Sequence[str] = (), right_on: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """Every two rows whose intervals have a point in common: the columns of ``left``, then of ``right``.

    Intervals run from their start to before their end, both dates, timestamps or integers of one
    type; a NULL end is open. Rows with a NULL start or an interval without points overlap nothing, nor
    do rows with a NULL key. ``left_on`` and ``right_on`` are keys that have to be equal too. Names
    must differ between the tables. Repeated rows give repeated pairs. ``width`` is the size of the finest
    bins in units of the bounds (days, microseconds); by default there are about as many as rows.

    Rows moved are those of both tables times the bins of an interval: about three, and one or two for each
    size that longer intervals of the other table have. No pair is moved. A key of at most ``SMALL_GROUP`` rows in
    either table is not cut. Neither side is broadcast, as its size in memory is not known before. A bin that a large part of the
    intervals share is one key of a shuffle join, whose tasks adaptive execution splits.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    if len(left_on) != len(right_on):
        raise ValueError("as many keys on either side")
    one, two = _prepared(left, left_bounds, left_on, "_left"), _prepared(right, right_bounds, right_on, "_right")
    known = [x for x in (_limits(one), _limits(two)) if x[0]]
    rows = sum(x[0] for x in known)
    base = min((x[1] for x in known), default=0)
    last_start = max((x[2] for x in known), default=0)
    width = width or max(1, -(-(last_start - base + 1) // max(1, rows)))
    bins, top = -(-(last_start + 1 - base) // width), 0
    while FAN**top < bins:
        top += 1
    keys = [f"_k{i}" for i in range(len(left_on))]
    crowded = _crowded(one, two, keys) if keys else None
    # Nothing starts after the last start, so no bins need reach further.
    first = F.col("_start") - base
    last = F.least(F.col("_end"), F.lit(last_start + 1)) - base - 1

    def leveled(rows: DataFrame) -> DataFrame:
        level = reduce(lambda found, k: F.when(last - first < 2 * width * FAN**k, k).otherwise(found),
                       reversed(range(top)), F.lit(top))
        if keys and crowded is None:
            level = F.lit(top)
        elif keys:
            rows = rows.join(broadcast_if_small(crowded.withColumn("_cut", F.lit(True))), keys, "left")
            level = F.when(F.col("_cut"), level).otherwise(top)
        return rows.withColumn("_level", level)
    one, two = leveled(one), leveled(two)
    ones, twos = (sorted(r[0] for r in rows.select("_level").distinct().collect()) for rows in (one, two))
    ones, twos = ones or [top], twos or [top]
    own = F.col("_level")
    # Pairing 0: the left interval's size is the larger one, or the same; pairing 1: the right one's is.
    places = {"_left": [(own == k, k, 0) for k in ones if k >= twos[0]] + [(own < k, k, 1) for k in twos if k > ones[0]],
              "_right": [(own <= k, k, 0) for k in ones if k >= twos[0]] + [(own == k, k, 1) for k in twos if k > ones[0]]}

    def placed(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(*keys, "_start", "_end", side, F.inline(_places(places[side], first, last, width)))
    c, p = placed(one, "_left"), placed(two, "_right")
    overlap = (F.col("c._start") < F.col("p._end")) & (F.col("p._start") < F.col("c._end"))
    pairs = c.alias("c").join(p.hint("merge").alias("p"), _all_equal([*keys, "level", "bin", "pairing"]) & overlap
                              & (F.col("c.opens") | F.col("p.opens")))
    return pairs.select("_left.*", "_right.*")


def _all_equal(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"c.{n}") == F.col(f"p.{n}") for n in names])
