import hashlib
import math
import random

import numpy as np
import pytest

from tablewarden.llm import centroids, pivots
from tests.conftest import rows

KINDS = "vec_id bigint, embedding array<float>, cluster string, ID string, hash int"


def plain(table, count=16, rounds=3, dims=64):
    """The contract in plain Python numbers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in table
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    fits = [(i, v) for i, v in kept if all(abs(x) < pivots.LIMIT for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v)
                   for i, v in fits if i is not None)
    centers = [v for _, _, v in named[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers))
                for _, v in fits]
    if not centers:
        return sorted(((i, None, None, None, None, None) for i, _ in kept), key=repr)
    for _ in range(rounds):
        near = assign()
        for n in range(len(centers)):
            own = [v for (_, v), (_, c) in zip(fits, near, strict=True) if c == n]
            if own:
                centers[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near = assign()
    inertia = {n: sum(d for d, c in near if c == n) for n in range(len(centers))}
    total = sum(inertia.values())
    out = [(i, c, d, inertia[c], total, hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
           for (i, _), (d, c) in zip(fits, near, strict=True)]
    out += [(i, None, None, None, total, None) for i, v in kept if not all(abs(x) < pivots.LIMIT for x in v)]
    return sorted(out, key=repr)


def run(spark, table, **how):
    df = spark.createDataFrame([(i, v, "c", "i", 0) for i, v in table], KINDS)
    return rows(centroids.clusters(df, **how), "id", "cluster", "distance", "cluster_inertia", "inertia",
                "centroid_sha256")


def vectors(count, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, 64))
    return [(int(i), (centers[i % 9] + spread * rng.normal(size=64)).astype(np.float32).tolist())
            for i in rng.permutation(count)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_plain_numbers(spark, spread):
    table = vectors(150, 3, spread)
    # Copies of one vector, more than a third of all rows.
    table += [(1000 + i, table[0][1]) for i in range(90)]
    assert run(spark, table) == plain(table)


def test_odd_vectors(spark):
    ok = [1.5] * 64
    table = [(1, ok), (1, ok), (1, [0.25] * 64), (2, None), (3, []), (4, [1.0] * 63), (5, [1.0] * 65),
             (6, [None] + ok[1:]), (7, [float("nan")] + ok[1:]), (8, [float("inf")] + ok[1:]), (None, [-3.0] * 64),
             (None, ok), (9, [2.0**21] + ok[1:]), (10, [-3e38] * 64), (11, [2.0**21 - 1] * 64)]
    got = run(spark, table)
    assert got == plain(table) and len(got) == 8
    assert run(spark, [(None, ok), (2, None)]) == plain([(None, ok)])
    assert run(spark, []) == []


def test_ties_go_to_the_smaller_number(spark):
    table = [(i, [float(i % 2)] * 64) for i in range(40)]
    assert run(spark, table) == plain(table)
    assert run(spark, table, pivots=1, rounds=1, count=5) == plain(table, count=5, rounds=1)


def test_bounds_rule_out_and_stay_exact():
    rng = np.random.default_rng(5)
    # Whole numbers on a line: the bounds of a pivot on the line are the distances themselves.
    rows_ = np.zeros((500, 64), np.int64)
    rows_[:, 0] = rng.integers(-(1 << 26), 1 << 26, 500)
    cents = rows_[:16].copy()
    table = pivots.choose_pivots(rows_, 4)
    cluster, best, computed = pivots.nearest(rows_, pivots.distances(rows_, table), cents, table)
    every = pivots.distances(rows_, cents)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert computed < 500 * 4
    for _ in range(50):
        wide = rng.integers(-pivots.LIMIT + 1, pivots.LIMIT, (40, 64)) >> random.Random(7).randrange(20)
        table = pivots.choose_pivots(wide, 3)
        cents = wide[rng.integers(0, 40, 16)]
        cluster, best, _ = pivots.nearest(wide, pivots.distances(wide, table), cents, table)
        every = pivots.distances(wide, cents)
        assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def test_a_single_task_and_many_give_the_same(spark):
    df = spark.createDataFrame(vectors(60, 9), "vec_id bigint, embedding array<double>")
    assert rows(centroids.clusters(df.coalesce(1))) == rows(centroids.clusters(df.repartition(7)))
