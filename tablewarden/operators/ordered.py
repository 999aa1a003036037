"""Ordered computations per group that also hold when one group is very large.

A window puts each group into one task. That is right for ordinary groups and wrong
for a group that holds a large part of the table. Each function here first counts the
rows per group (one aggregate over the key columns). Groups of at most ``max_rows``
rows use a plain window. Larger groups are range-partitioned by their order, so that
one group spans many tasks, each slice is worked on by itself, and a small summary per
slice carries the state across. Results do not depend on ``max_rows``.

Sort columns are named, with a leading ``-`` for descending. NULLs come first in
ascending and last in descending order. Where the result depends on the order of
equal rows, the sort columns must make the order total.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tablewarden.operators.lookup import broadcast_if_small
from tablewarden.storage import materialize

MAX_GROUP_ROWS = 5_000_000

# Upper bound on the tasks that one table of large groups is cut into.
MAX_SLICES = 50_000

_SLICE, _POS, _BLOCK = "_slice", "_pos", "_block"


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first()
            for c in order]


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Rows of the largest group: one aggregate over the key columns, one number back."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.agg(F.max("_rows")).first()[0] or 0


def limit_if_exceeded(df: DataFrame, by: Sequence[str], max_rows: int | None, times: int = 1
                      ) -> int | None:
    """``max_rows`` when a group of ``df``, taken ``times`` over, exceeds it, else None.

    For operators of several ordered steps: one count of the input settles that the
    steps need none of their own.
    """
    if max_rows is None or times * largest_group(df, by) <= max_rows:
        return None
    return max_rows


@dataclass(frozen=True)
class Arranged:
    """A table made ready for ordered steps that share one grouping and order.

    ``model`` is the table with plain windows; it is the result when no group is large.
    Otherwise ``ordinary`` holds the small groups and ``large`` the written rows of the
    others, in order, with the slice and the position of each row.
    """

    by: Sequence[str]
    order: Sequence[str]
    max_rows: int | None
    model: DataFrame
    ordinary: DataFrame | None = None
    large: DataFrame | None = None

    def _with(self, step: Callable[[DataFrame], DataFrame],
              sliced: Callable[[DataFrame], DataFrame]) -> Arranged:
        return replace(self, model=step(self.model),
                       ordinary=None if self.ordinary is None else step(self.ordinary),
                       large=None if self.large is None else sliced(self.large))

    def map(self, step: Callable[[DataFrame], DataFrame]) -> Arranged:
        """A step that keeps rows and their columns, such as ``withColumn``."""
        return self._with(step, step)

    def running(self, values: Mapping[str, tuple[str, str | Column]]) -> Arranged:
        return self._with(lambda df: _running_plain(df, self.by, self.order, values),
                          lambda df: _running_sliced(df, self.by, values))

    def windowed(self, columns: Mapping[str, Callable[[WindowSpec], Column]], before: int,
                 after: int) -> Arranged:
        return self._with(
            lambda df: _windowed_plain(df, self.by, self.order, columns),
            lambda df: _windowed_blocks(df, self.by, columns, before, after, self.max_rows))

    def rows(self) -> DataFrame:
        if self.large is None:
            return self.model
        kinds = dict(self.large.dtypes)
        # A sum of sums is a wider decimal than the sum.
        large = self.large.select(*[
            F.col(n) if kinds[n] == kind else F.col(n).cast(kind).alias(n)
            for n, kind in self.model.dtypes])
        return large if self.ordinary is None else self.ordinary.unionByName(large)


def arrange(df: DataFrame, by: Sequence[str], order: Sequence[str],
            max_rows: int | None = MAX_GROUP_ROWS) -> Arranged:
    """Count the groups and lay the large ones out; ``max_rows=None`` skips the count."""
    plain = Arranged(by, order, max_rows, df)
    if max_rows is None:
        return plain
    sizes = (df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
             .where(F.col("_rows") > max_rows))
    rows = sizes.agg(F.sum("_rows")).first()[0]
    if not rows:
        return plain
    if by:
        # At most (rows of the table / max_rows) keys, so these broadcasts are small.
        keys = materialize(sizes.select(*by), "large_groups")
        ordinary = _join_small(df, keys, by, "left_anti")
        chosen = _join_small(df, keys, by, "left_semi")
    else:
        ordinary, chosen = None, df
    shuffle_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(shuffle_tasks, min(MAX_SLICES, 2 * -(-rows // max_rows)))
    keys = [F.col(b).asc_nulls_first() for b in by] + sort_columns(order)
    laid = (chosen.repartitionByRange(slices, *keys).sortWithinPartitions(*keys)
            .withColumn(_SLICE, F.spark_partition_id())
            .withColumn(_POS, F.monotonically_increasing_id()))
    return replace(plain, ordinary=ordinary, large=materialize(laid, "slices"))


def _join_small(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                mark: Callable[[DataFrame], DataFrame] = F.broadcast) -> DataFrame:
    """NULL-safe join that keeps the key columns of ``left`` only; broadcast unless ``mark`` says else."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(mark(renamed), on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


# name -> (aggregate over rows so far, value of one slice, merge of slice values, combination)
_RUNNING: dict[str, tuple[Callable, Callable, Callable, Callable]] = {
    "sum": (F.sum, F.sum, F.sum,
            lambda before, here: F.when(before.isNull(), here).when(here.isNull(), before)
            .otherwise(before + here)),
    "count": (F.count, F.count, F.sum,
              lambda before, here: F.coalesce(before, F.lit(0)) + here),
    "min": (F.min, F.min, F.min, F.least),
    "max": (F.max, F.max, F.max, F.greatest),
    "last": (lambda c: F.last(c, ignorenulls=True),
             lambda c: F.max_by(c, F.when(c.isNotNull(), F.col(_POS))),
             lambda c: F.last(c, ignorenulls=True),
             lambda before, here: F.coalesce(here, before)),
    "first": (lambda c: F.first(c, ignorenulls=True),
              lambda c: F.min_by(c, F.when(c.isNotNull(), F.col(_POS))),
              lambda c: F.first(c, ignorenulls=True),
              lambda before, here: F.coalesce(before, here)),
}


def _running_plain(df: DataFrame, by: Sequence[str], order: Sequence[str],
                   values: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    whole = Window.partitionBy(*by)
    upto = whole.orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *[
        (F.sum(c).over(whole) if fn == "total" else _RUNNING[fn][0](c).over(upto)).alias(n)
        for n, (fn, c) in values.items()])


def _running_sliced(laid: DataFrame, by: Sequence[str],
                    values: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    """Running values within each slice, on top of the values of the slices before it."""
    kept = laid.columns
    laid = laid.select("*", *[(F.col(c) if isinstance(c, str) else c).alias(f"_in_{n}")
                              for n, (_, c) in values.items()])
    # One row per (large group, slice): bounded by the number of slices plus large groups.
    per_slice = laid.groupBy(*by, _SLICE).agg(*[
        (F.sum(f"_in_{n}") if fn == "total" else _RUNNING[fn][1](F.col(f"_in_{n}")))
        .alias(f"_at_{n}") for n, (fn, _) in values.items()])
    group = Window.partitionBy(*by)
    before = group.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(*by, _SLICE, *[
        (F.sum(f"_at_{n}").over(group) if fn == "total"
         else _RUNNING[fn][2](F.col(f"_at_{n}")).over(before)).alias(f"_before_{n}")
        for n, (fn, _) in values.items()])
    here = (Window.partitionBy(*by, _SLICE).orderBy(_POS)
            .rowsBetween(Window.unboundedPreceding, 0))
    within = laid.select("*", *[
        _RUNNING[fn][0](F.col(f"_in_{n}")).over(here).alias(f"_here_{n}")
        for n, (fn, _) in values.items() if fn != "total"])
    # Few rows, but a value may be a whole row of another table, so their bytes are measured. Beyond
    # the limit the join goes by slice, which bounds the rows of a key.
    joined = _join_small(within, materialize(carried, "carried"), [*by, _SLICE], "left",
                         broadcast_if_small)
    return joined.select(*kept, *[
        (F.col(f"_before_{n}") if fn == "total"
         else _RUNNING[fn][3](F.col(f"_before_{n}"), F.col(f"_here_{n}"))).alias(n)
        for n, (fn, _) in values.items()])


def _windowed_plain(df: DataFrame, by: Sequence[str], order: Sequence[str],
                    columns: Mapping[str, Callable[[WindowSpec], Column]]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*sort_columns(order))
    return df.select("*", *[make(w).alias(n) for n, make in columns.items()])


def _windowed_blocks(laid: DataFrame, by: Sequence[str],
                     columns: Mapping[str, Callable[[WindowSpec], Column]], before: int,
                     after: int, max_rows: int) -> DataFrame:
    """Windows over blocks of consecutive rows; rows that a neighbour can see are copied to it."""
    kept = laid.columns
    size = max(max_rows, before + after, 1)
    # A group lies in consecutive positions of a slice, so its first position and the rows
    # in earlier slices give every row's rank without sorting again.
    starts = laid.groupBy(*by, _SLICE).agg(F.min(_POS).alias("_start"),
                                           F.count(F.lit(1)).alias("_rows"))
    earlier = (Window.partitionBy(*by).orderBy(_SLICE)
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select(*by, _SLICE, "_start",
                           F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    ranked = (_join_small(laid, starts, [*by, _SLICE], "left")
              .withColumn("_rank", F.col("_offset") + F.col(_POS) - F.col("_start")))
    block = F.floor(F.col("_rank") / size)
    inside = F.col("_rank") % size
    homes = F.array_compact(F.array(
        block,
        F.when(inside >= size - before, block + 1),
        F.when((inside < after) & (block > 0), block - 1)))
    copied = ranked.select(*kept, "_rank", block.alias("_home"), F.explode(homes).alias(_BLOCK))
    w = Window.partitionBy(*by, _BLOCK).orderBy("_rank")
    return (copied.select("*", *[make(w).alias(n) for n, make in columns.items()])
            .where(F.col("_home") == F.col(_BLOCK)).select(*kept, *columns))


def running(df: DataFrame, by: Sequence[str], order: Sequence[str],
            values: Mapping[str, tuple[str, str | Column]],
            max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Add running values, the current row included.

    ``values`` maps a new column to (function, input); the functions are sum, count, min,
    max, last (newest non-NULL value), first, and total (sum over the whole group).
    """
    return arrange(df, by, order, max_rows).running(values).rows()


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "row_number",
                max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Add the position of each row in its group, from 1."""
    return running(df, by, order, {name: ("count", F.lit(1))}, max_rows)


def windowed(df: DataFrame, by: Sequence[str], order: Sequence[str],
             columns: Mapping[str, Callable[[WindowSpec], Column]], before: int, after: int,
             max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Add columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` maps a name to a function of an ordered window, for example
    ``lambda w: F.avg("v").over(w.rowsBetween(-3, 0))`` or ``lambda w: F.lag("v").over(w)``.
    """
    return arrange(df, by, order, max_rows).windowed(columns, before, after).rows()


def last_known(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str],
               max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Replace NULLs in ``columns`` by the newest earlier value of the group."""
    kept = {f"_filled_{c}": ("last", c) for c in columns}
    filled = running(df, by, order, kept, max_rows)
    return filled.select(*[F.col(f"_filled_{c}").alias(c) if c in columns else F.col(c)
                           for c in df.columns])
