"""Near-repeats: values within a small edit distance, records that agree in all fields but one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _deletions(values: Column) -> Column:
    """The texts, plus each with one character removed."""
    def shorter(v: Column) -> Column:
        return F.when(F.length(v) > 0, F.transform(
            F.sequence(F.lit(1), F.length(v)),
            lambda i: F.concat(F.substr(v, F.lit(1), i - 1), F.substr(v, i + 1))))
    return F.array_distinct(F.flatten(F.transform(
        values, lambda v: F.concat(F.array(v), F.coalesce(shorter(v), F.array().cast("array<string>"))))))


def _shared_texts(df: DataFrame, col: str, max_dist: int, block: Sequence[str]) -> DataFrame:
    """(block, shared, value, rows): each distinct value with the texts left after deletions."""
    values = (df.where(F.col(col).isNotNull()).groupBy(*block, col)
              .agg(F.count(F.lit(1)).alias("rows")))
    # Few values make many keys, so they are spread over all tasks first.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = values.repartition(tasks, *block, col)
    keys = F.array(F.col(col))
    for _ in range(max_dist):
        keys = _deletions(keys)
    return values.select(*block, F.explode(F.array_distinct(keys)).alias("shared"),
                         F.col(col).alias("value"), "rows")


def fuzzy_groups(df: DataFrame, col: str, max_dist: int = 1, block: Sequence[str] = ()) -> DataFrame:
    """Groups of different values that agree after at most ``max_dist`` deletions from each.

    One row per shared text: how many values leave it, the lowest and highest of them, and
    their rows. Values within ``max_dist`` edits always share a group; no pairs are listed, and
    one shuffle brings a group together as counts.
    """
    spread = _shared_texts(df, col, max_dist, block)
    return (spread.groupBy(*block, "shared").agg(
        F.count(F.lit(1)).alias("value_count"), F.min("value").alias("lowest"),
        F.max("value").alias("highest"), F.sum("rows").alias("rows"))
        .where(F.col("value_count") > 1))


def fuzzy_pairs(df: DataFrame, col: str, max_dist: int = 1, block: Sequence[str] = ()
                ) -> DataFrame:
    """Pairs of different values within ``max_dist`` edits, optionally inside a block.

    Equal values are counted once, so copies make no pairs among themselves. Two texts
    within d edits share a text that is left after at most d deletions from each; joining
    on those finds every pair without comparing a block with itself. How many values can
    share such a text is bounded by its length and the alphabet, not by the table; still the
    result grows with the number of near pairs, and ``fuzzy_groups`` is the form that does not.
    The texts are joined by their hash; the distance is checked afterwards.
    """
    spread = _shared_texts(df, col, max_dist, block).withColumn("_key", F.xxhash64("shared"))
    left = spread.select(*block, "_key", F.col("value").alias("left_value"),
                         F.col("rows").alias("left_rows"))
    right = spread.select(*block, "_key", F.col("value").alias("right_value"),
                          F.col("rows").alias("right_rows"))
    near = F.levenshtein("left_value", "right_value", max_dist)
    # With a threshold, levenshtein gives -1 beyond it.
    return (left.join(right, [*block, "_key"])
            .where(F.col("left_value") < F.col("right_value"))
            .withColumn("distance", near).where(F.col("distance") >= 0)
            .drop("_key").distinct())


def near_repeats(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Groups of records that agree in all of ``fields`` but one.

    One row per group and differing field: the agreeing values (NULL in the differing
    field), how many values the field takes, the smallest and largest of them as text, and
    the rows. A group is one result row whatever its size; no pairs are listed.
    """
    records = df.groupBy(*fields).agg(F.count(F.lit(1)).alias("_n"))
    copies = records.select("*", *[F.col(f).cast("string").alias(f"_v_{f}") for f in fields])
    sets = [[F.col(g) for g in fields if g != f] for f in fields]
    grouped = copies.groupingSets(sets, *[F.col(f) for f in fields])
    differing = F.coalesce(*[F.when(F.grouping(f) == 1, F.lit(f)) for f in fields])
    def of(fn):
        return F.coalesce(*[F.when(F.grouping(f) == 1, fn(f"_v_{f}")) for f in fields])
    return (grouped.agg(differing.alias("differing_field"), F.count(F.lit(1)).alias("value_count"),
                        of(F.min).alias("lowest"), of(F.max).alias("highest"),
                        F.sum("_n").alias("rows"))
            .where(F.col("value_count") > 1))
