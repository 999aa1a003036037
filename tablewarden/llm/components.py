"""Connected components of a stored edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import materialize
from tablewarden.storage import release


# Edges for a task to work on; fewer edges take fewer tasks.
TASK_EDGES = 50_000


def _stars(edges: DataFrame, tasks: int) -> DataFrame:
    """One large-star and one small-star step; every step keeps the components.

    A node of very many neighbours sends its smallest one through a partial aggregate, and
    the joins have plain shuffles on both sides, so adaptive execution can split its rows.
    """
    both = materialize(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                       "edges_both")
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select("a", F.least("a", "m").alias("m")).coalesce(tasks), "edges_least")
    large = (both.where(F.col("b") > F.col("a")).join(least, "a")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    # Every edge of ``large`` points from the larger node to the smaller one.
    large = materialize(large.where(F.col("a") != F.col("b")).distinct().coalesce(tasks), "edges_large")
    release(both, least)
    least = materialize(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks), "edges_least")
    small = (large.join(least, "a").where(F.col("b") != F.col("m"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    small = small.unionAll(least.select("a", F.col("m").alias("b")))
    small = materialize(small.distinct().coalesce(tasks), "edges_small")
    release(large, least)
    return small


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                    F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; the root is the smallest node reached.

    ``edges`` has columns ``a`` and ``b`` of one ordered type. Repeated edges and loops do not
    matter; a node with loops only is left out. Only a count and two checksums reach the driver.
    """
    edges = materialize(edges.select("a", "b").where(F.col("a") != F.col("b"))
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "edges")
    mark = _mark(edges)
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while mark[0]:
        last = edges
        edges = _stars(last, max(8, min(most, mark[0] // TASK_EDGES)))
        release(last)
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    # Now every edge joins a node with the root of its component.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select("b", "b").distinct())
