"""Centroid clustering of integer vectors with a table of pivot distances."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm import pivots as tasks
from tablewarden.storage import materialize

CLUSTERS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64.0
# Pivots, and the vectors that they are chosen from. Neither changes a result.
PIVOTS, SAMPLE = 8, 512


def clusters(df: DataFrame, vector: str = "embedding", ident: str = "vec_id", count: int = CLUSTERS,
             rounds: int = ROUNDS, dims: int = DIMS, scale: float = SCALE, pivots: int = PIVOTS,
             seed: int = 1) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that counts.

    Vectors of exactly ``dims`` components, none NULL or infinite or NaN, count; each component x
    becomes floor(scale * x). The first centroids are the ``count`` vectors with the smallest
    SHA-256 of ``seed:id``, in that order. Each round assigns all vectors to the nearest centroid
    and moves every centroid that has vectors to the floor of their mean; a last assignment follows.
    All sums and squared distances are exact integers; the smaller number wins a tie.

    The distances of every vector to a few fixed pivots are stored once. In each round they bound
    its distance to every centroid from below, and only centroids that the bounds leave are
    compared. Each pass is one map over the stored table; a task gives one sum per cluster and
    component, so neither copies of a vector nor a large cluster meet in one task, and the driver
    holds the centroids only.

    Repeated rows and equal ids count as often as they are there (equal ids start centroids in the
    order of their packed components). A vector without an id is assigned but starts no centroid; when
    there are fewer vectors with ids than ``count`` there are fewer centroids, and with none cluster
    and the columns after it are NULL. So they are for a vector with a component of 2**27 or more
    after scaling, whose squared distances would not fit a long; it moves no centroid. A sum of
    distances beyond a long is NULL. Other columns are not looked at. Of an empty table the
    result is empty.
    """
    if dims > 64:
        raise ValueError("squared distances fit a long for 64 components at most")
    spark = df.sparkSession
    vectors = df.select(F.col(ident).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    kind = dict(vectors.dtypes)["id"]
    counted = vectors.mapInArrow(partial(tasks.quantise_batches, dims=dims, scale=scale), f"id {kind}, parts binary")
    fitting = counted.where(F.col("parts").isNotNull())
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    # A sample of fixed size: the first of it start the centroids, the pivots are chosen among all.
    rows = fitting.select(named.alias("hash"), "parts").where(F.col("hash").isNotNull()) \
        .orderBy("hash", "parts").limit(max(SAMPLE, count)).select("parts").collect()
    sample = np.array([np.frombuffer(r.parts, "<i4") for r in rows], np.int64).reshape(-1, dims)
    points, centroids = tasks.choose_pivots(sample, pivots), sample[:count].copy()
    none = F.lit(None)
    columns = ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not len(centroids):
        return counted.select("id", none.cast("int"), none.cast("bigint"), none.cast("bigint"),
                              none.cast("bigint"), none.cast("string")).toDF(*columns)
    table = materialize(fitting.mapInArrow(partial(tasks.pivot_batches, pivots=points),
                                           f"id {kind}, parts binary, to_pivots binary"), "pivot_table")
    for _ in range(rounds):
        sums = table.mapInArrow(partial(tasks.sum_batches, centroids=centroids, pivots=points),
                                "cluster bigint, place bigint, total bigint, rows bigint")
        # One row per cluster and component.
        moved = sums.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
        centroids = centroids.copy()
        for r in moved.collect():
            centroids[r.cluster, r.place] = r.total // r.rows
    assigned = materialize(table.mapInArrow(
        partial(tasks.assign_batches, centroids=centroids, pivots=points),
        f"id {kind}, cluster int, distance bigint"), "assigned_vectors")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    per_cluster = assigned.groupBy("cluster").agg(wide.alias("own")).collect()
    inertia = {r.cluster: _long(int(r.own)) for r in per_cluster}
    total = _long(sum(int(r.own) for r in per_cluster))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of_cluster(values: list, kind: str):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))
    placed = assigned.select(
        "id", "cluster", "distance", of_cluster([inertia.get(i) for i in range(len(centroids))], "bigint"),
        F.lit(total).cast("bigint"), of_cluster(digests, "string")).toDF(*columns)
    beyond = counted.where(F.col("parts").isNull()).select(
        "id", none.cast("int"), none.cast("bigint"), none.cast("bigint"), F.lit(total).cast("bigint"),
        none.cast("string")).toDF(*columns)
    return placed.unionAll(beyond)


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None

