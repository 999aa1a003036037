"""Transforms: lookups, as-of and validity joins, summaries, ranks, moving values, sets."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewarden.functions import columns as X
from tablewarden.operators.cleaning import join_group_stats, ntile_of
from tablewarden.operators.lookup import MAX_BROADCAST_BYTES, lookup_join
from tablewarden.operators.ordered import (
    MAX_GROUP_ROWS, largest_group, limit_if_exceeded, number_rows, running, sort_columns,
    windowed)


def enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner",
           measure: bool = False, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Dimension lookup; ``measure`` as for ``lookup_join``."""
    return lookup_join(fact, dim, on, how, measure, max_bytes)


def keep_matching(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with a partner. Repeated keys of ``other`` collapse before its shuffle."""
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def drop_matching(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner. Repeated keys of ``other`` collapse before its shuffle."""
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def join_asof(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str, right_ts: str,
              values: Sequence[str], max_rows: int | None = MAX_GROUP_ROWS,
              tie: Sequence[str] = ()) -> DataFrame:
    """Each left row with the newest right row of the key at or before its time.

    Both tables are stacked and the newest right row is carried forward, so the work is
    linear in the rows; no pairs are built. The carried value is a struct, so NULLs in a
    matched row stay NULL. ``tie`` orders right rows of equal time, the last one wins.
    """
    stacked_right = right.select(
        *key, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"),
        *[F.col(c).alias(f"_tie_{c}") for c in tie],
        F.struct(*values).alias("_right"))
    # The hash of a left row only spreads left rows of one key and time over slices. Maps have none.
    hashed = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    stacked_left = left.select(*key, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"),
                               F.xxhash64(F.lit(0), *hashed).alias("_spread"),
                               F.struct(*left.columns).alias("_left"))
    stacked = stacked_right.unionByName(stacked_left, allowMissingColumns=True)
    order = ["_ts", "_side", *[f"_tie_{c}" for c in tie], "_spread"]
    if max_rows is not None and largest_group(left, key) + largest_group(right, key) <= max_rows:
        max_rows = None
    carried = running(stacked, key, order, {"_match": ("last", "_right")}, max_rows)
    return (carried.where(F.col("_side") == 1)
            .select("_left.*", *[F.col(f"_match.{c}").alias(c) for c in values]))


def join_valid(df: DataFrame, history: DataFrame, key: Sequence[str], ts: str,
               values: Sequence[str], valid_from: str = "valid_from", valid_to: str = "valid_to",
               max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Each row with the version valid at its time: from inclusive, to exclusive, NULL open.

    The versions of a key do not overlap, so the newest version that has started is the
    only candidate; rows where it has ended get NULLs.
    """
    ends = "_valid_to"
    found = join_asof(df, history.withColumn(ends, F.col(valid_to)), key, ts, valid_from,
                      [*values, ends, valid_from], max_rows)
    valid = F.col(valid_from).isNotNull() & (F.col(ends).isNull() | (F.col(ts) < F.col(ends)))
    return found.select(*df.columns, *[F.when(valid, F.col(v)).alias(v) for v in values])


def summarize(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])


def subtotals(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column], how: str = "rollup",
              sets: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Rollup, cube or explicit grouping sets, with ``level`` telling the sets apart."""
    if how == "sets":
        grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by])
    else:
        grouped = {"rollup": df.rollup, "cube": df.cube}[how](*by)
    return grouped.agg(F.grouping_id().alias("level"),
                       *[c.alias(n) for n, c in measures.items()])


def distinct_count(df: DataFrame, by: Sequence[str], col: str, exact: bool = True,
                   rsd: float = 0.02, name: str = "distinct") -> DataFrame:
    count = F.count_distinct(col) if exact else F.approx_count_distinct(col, rsd)
    return df.groupBy(*by).agg(count.alias(name))


def pivot(df: DataFrame, by: Sequence[str], col: str, values: Sequence[object],
          measure: Column, rest: str = "other") -> DataFrame:
    """Rows to columns; the values are given, so no extra pass finds them.

    Rows whose value is not listed, or NULL, are measured in the column ``rest``.
    """
    names = [str(v) for v in values]
    if rest in names:
        raise ValueError(f"{rest} is one of the values; name another column for the rest")
    text = F.col(col).cast("string")
    listed = F.when(text.isin(names), text).otherwise(F.lit(rest))
    return df.withColumn(col, listed).groupBy(*by).pivot(col, [*names, rest]).agg(measure)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "name",
            value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def rank_in(df: DataFrame, by: Sequence[str], order: Sequence[str], kind: str, name: str = "rank",
            tiles: int = 4, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank or ntile.

    Spark's own functions where all groups are small. In larger ones, the ranks with ties
    count equal values first and number the distinct ones, so a value shared by very many
    rows is one row in the ordered step.
    """
    direct = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank,
              "percent_rank": F.percent_rank, "ntile": lambda: F.ntile(tiles)}[kind]
    max_rows = limit_if_exceeded(df, by, max_rows)
    if max_rows is None:
        w = Window.partitionBy(*by).orderBy(*sort_columns(order))
        value = direct().over(w)
        return df.withColumn(name, value if kind == "percent_rank" else value.cast("bigint"))
    if kind == "row_number":
        return number_rows(df, by, order, name, max_rows)
    if kind == "ntile":
        ranked = running(df.withColumn("_one", F.lit(1)), by, order,
                         {"_rank": ("count", "_one"), "_total": ("total", "_one")}, max_rows)
        tile = ntile_of(F.col("_rank"), F.col("_total"), tiles).cast("bigint")
        return ranked.withColumn(name, tile).drop("_one", "_rank", "_total")
    keys = [c.lstrip("-") for c in order]
    values = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_n"))
    placed = running(values, by, order, {"_upto": ("sum", "_n"), "_dense": ("count", "_n"),
                                         "_total": ("total", "_n")}, max_rows)
    rank = F.col("_upto") - F.col("_n") + 1
    result = {"rank": rank, "dense_rank": F.col("_dense"),
              "percent_rank": F.coalesce((rank - 1) / F.nullif(F.col("_total") - 1, F.lit(0)),
                                         F.lit(0.0))}[kind]
    stats = placed.select(*by, *keys, result.alias(name))
    return join_group_stats(df, stats, [*by, *keys])


def moving(df: DataFrame, by: Sequence[str], order: Sequence[str],
           columns: Mapping[str, Callable], before: int, after: int = 0,
           max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Moving aggregates over a row frame and lagged values (see ``windowed``)."""
    return windowed(df, by, order, columns, before, after, max_rows)


def moving_by_time(df: DataFrame, by: Sequence[str], ts: str, seconds: float, value: str,
                   max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Count and sum of ``value`` over the trailing ``seconds``, per group and time.

    Each row enters at its time and leaves just after ``seconds``; the running sum of both
    is the moving sum. Rows at either end of the interval are inside it, and rows of equal
    time give one result row. ``value`` should be decimal or integer, so that leaving
    values cancel exactly.
    """
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds).cast("decimal(18,6)"))
    max_rows = limit_if_exceeded(df, by, max_rows, times=2)
    source = df.select(*by, F.col(ts).alias("_ts"), F.col(value).alias("_value"))
    if max_rows is None and by:
        # One shuffle then serves both the grouping by time and the window.
        source = source.repartition(*by)
    points = source.groupBy(*by, "_ts").agg(
        F.sum("_value").alias("_sum"), F.count("_value").alias("_count"))
    moves = points.select(*by, F.inline(F.array(
        F.struct("_ts", "_sum", "_count", F.lit(0).alias("_leaves")),
        F.struct((F.col("_ts") + span).alias("_ts"), (-F.col("_sum")).alias("_sum"),
                 (-F.col("_count")).alias("_count"), F.lit(1).alias("_leaves")))))
    both = running(moves, by, ["_ts", "_leaves"],
                   {"moving_sum": ("sum", "_sum"), "moving_count": ("sum", "_count")}, max_rows)
    return (both.where(F.col("_leaves") == 0)
            .select(*by, F.col("_ts").alias(ts), "moving_sum", "moving_count"))


def top_k(df: DataFrame, k: int, order: Sequence[str], by: Sequence[str] | None = None,
          max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """First ``k`` rows overall, or per group.

    Up to 1,000 per group, Spark keeps the first ``k`` per key and task before the
    shuffle, so a large group does not reach one task. More go through the numbered form.
    """
    if not by:
        return df.orderBy(*sort_columns(order)).limit(k)
    if k <= 1000:
        w = Window.partitionBy(*by).orderBy(*sort_columns(order))
        ranked = df.withColumn("_rn", F.row_number().over(w))
    else:
        ranked = number_rows(df, by, order, "_rn", max_rows)
    return ranked.where(F.col("_rn") <= k).drop("_rn")


def union_by_name(a: DataFrame, b: DataFrame, all: bool = True) -> DataFrame:
    both = a.unionByName(b)
    return both if all else both.distinct()


# How many copies of one row a single task writes out.
COPIES_PER_TASK = 1_000_000


def _copies(a: DataFrame, b: DataFrame, wanted: Callable[[Column, Column], Column]) -> DataFrame:
    """Rows with as many copies as ``wanted`` says from their counts in ``a`` and ``b``.

    Copies are counted before the shuffle, and a row with very many copies is written out
    by several tasks.
    """
    columns = a.columns
    tagged = a.withColumns({"_a": F.lit(1), "_b": F.lit(0)}).unionByName(
        b.select(*columns).withColumns({"_a": F.lit(0), "_b": F.lit(1)}))
    counted = tagged.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    size = F.lit(COPIES_PER_TASK)
    pieces = (counted.select(*columns, wanted(F.col("_a"), F.col("_b")).alias("_n"))
              .where(F.col("_n") > 0)
              .select(*columns, "_n", F.explode(
                  F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / size))).alias("_piece")))
    here = F.least(size, F.col("_n") - F.col("_piece") * size).cast("int")
    return (pieces.repartition(*columns, "_piece")
            .select(*columns, F.explode(F.sequence(F.lit(1), here)).alias("_copy")).drop("_copy"))


def intersect(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    if all:
        return _copies(a, b, F.least)
    return a.distinct().intersect(b.select(*a.columns).distinct())


def subtract(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    if all:
        return _copies(a, b, lambda x, y: x - y)
    return a.distinct().subtract(b.select(*a.columns).distinct())


def date_dim(days: DataFrame, start: str = "first_day", end: str = "last_day") -> DataFrame:
    """Calendar rows for the interval that each row of ``days`` names."""
    day = F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))).alias("day")
    return days.select(day).distinct().select(
        "day", F.year("day").alias("year"), F.quarter("day").alias("quarter"),
        F.month("day").alias("month"), F.dayofmonth("day").alias("day_of_month"),
        (F.dayofweek("day") - 1).alias("day_of_week"), F.weekofyear("day").alias("iso_week"),
        F.dayofweek("day").isin(1, 7).alias("weekend"))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar rows for a literal interval."""
    return date_dim(spark.range(1).select(F.lit(start).alias("first_day"),
                                          F.lit(end).alias("last_day")))


def surrogate_key(df: DataFrame, cols: Sequence[str], name: str = "sk") -> DataFrame:
    return df.withColumn(name, X.surrogate_key(cols))


def apply_udf(df: DataFrame, name: str, function: Callable[..., pd.Series], returns: str,
              *inputs: str) -> DataFrame:
    """Add a column computed by a vectorized user function."""
    return df.withColumn(name, F.pandas_udf(function, returns)(*[F.col(c) for c in inputs]))


def apply_batches(df: DataFrame, function: Callable[[Iterable[pd.DataFrame]], Iterable[pd.DataFrame]],
                  schema: str) -> DataFrame:
    """User function over batches of rows, in whatever way the table is partitioned."""
    return df.mapInPandas(function, schema)


def apply_group(df: DataFrame, by: Sequence[str], function: Callable[[pd.DataFrame], pd.DataFrame],
                schema: str) -> DataFrame:
    """User function over whole groups.

    The function sees its group as one frame, so a group has to fit into a task's memory; a
    function whose results can be merged belongs in ``apply_partial_groups``, which has no such
    limit.
    """
    return df.groupBy(*by).applyInPandas(function, schema)


def apply_partial_groups(df: DataFrame, by: Sequence[str],
                         partial: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                         merge: Mapping[str, Column]) -> DataFrame:
    """User aggregate in two steps: ``partial`` on each batch of rows, ``merge`` in Spark.

    ``partial`` turns a batch, which holds pieces of many groups, into rows of ``schema``
    with the ``by`` columns. Batches are small and unshuffled, so the size of a group does
    not matter.
    """
    def each(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield partial(batch)
    return (df.mapInPandas(each, schema).groupBy(*by)
            .agg(*[c.alias(n) for n, c in merge.items()]))


def apply_udtf(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
               *inputs: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows that a user table function makes from each input row, with the ``keep`` columns.

    The function takes a batch of the ``inputs`` and returns the rows it makes of it; their index
    says which input row they come from. It is called once per batch, never per row.
    """
    kept = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)

    def each(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            yield batch[list(keep)].join(function(batch[list(inputs)]), how="inner")
    columns = list(dict.fromkeys([*keep, *inputs]))
    return df.select(*columns).mapInPandas(each, f"{kept}, {schema}" if kept else schema)
