"""Nearest centroids by a table of pivot distances: exact work on integers, inside one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Components of this size or more do not fit: 64 squared differences of smaller ones fit a long.
LIMIT = 1 << 27
# Rows that are compared with the centroids at a time.
BLOCK = 4096


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors of the sample that lie far apart: each is the one with the largest summed distance to those before."""
    if not len(sample):
        return sample
    chosen, total = [0], np.zeros(len(sample))
    while len(chosen) < min(count, len(sample)):
        total += np.sqrt(squared(sample, sample[chosen[-1]]))
        total[chosen] = -1
        chosen.append(int(np.argmax(total)))
    return sample[chosen]


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of every row to a few points."""
    return np.stack([squared(rows, p) for p in points], axis=1) if len(points) else np.zeros((len(rows), 0), np.int64)


def nearest(rows: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance) of each row, and how many distances were computed.

    For any pivot p, |d(x, p) - d(c, p)| is at most d(x, c). Centroids are taken in order of the
    largest such bound; once the bound exceeds the smallest distance found, the rest is ruled out.
    Bounds are lowered by more than rounding can raise them, so they never rule out an equal one.
    """
    n, k = len(rows), len(centroids)
    cluster, best, computed = np.full(n, -1, np.int64), np.full(n, np.iinfo(np.int64).max, np.int64), 0
    own, other = np.sqrt(to_pivots.astype(float)), np.sqrt(distances(centroids, pivots).astype(float))
    bound = np.zeros((n, k))
    for j in range(own.shape[1]):
        a, b = own[:, j, None], other[None, :, j]
        np.maximum(bound, np.abs(a - b) - 1e-15 * (a + b), out=bound)
    bound = bound * bound * (1 - 1e-14)
    order = np.argsort(bound, axis=1, kind="stable")
    alive = np.arange(n)
    for r in range(k):
        c = order[alive, r]
        keep = bound[alive, c] <= best[alive]
        alive, c = alive[keep], c[keep]
        if not len(alive):
            break
        d = squared(rows[alive], centroids[c])
        computed += len(alive)
        better = (d < best[alive]) | (d == best[alive]) & (c < cluster[alive])
        best[alive[better]], cluster[alive[better]] = d[better], c[better]
    return cluster, best, computed


def quantise_batches(batches: Iterator[pa.RecordBatch], dims: int, scale: float) -> Iterator[pa.RecordBatch]:
    """(id, vector) in; (id, components as 32-bit integers) of the vectors that count out, NULL beyond ``LIMIT``."""
    for batch in batches:
        column = batch.column(1)
        if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
            column = column.cast(pa.list_(column.type.value_type))
        fits = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
        ids, column = batch.column(0).filter(fits), column.filter(fits)
        flat = column.flatten().cast(pa.float64())
        values = np.asarray(flat.fill_null(np.nan)).reshape(-1, dims)
        finite = np.isfinite(values).all(axis=1)
        with np.errstate(over="ignore"):
            values = np.floor(values[finite] * scale)
        small = (np.abs(values) < LIMIT).all(axis=1)
        parts = np.where(small[:, None], values, 0).astype("<i4")
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(finite)), pa.array(
            [p.tobytes() if s else None for p, s in zip(parts, small.tolist(), strict=True)], pa.binary())],
            ["id", "parts"])


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of ``width`` numbers from a column of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).astype(np.int64)


def pivot_batches(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, parts) in; (id, parts, squared distances to the pivots as 64-bit integers) out."""
    for batch in batches:
        rows = _matrix(batch.column(1), "<i4", pivots.shape[1])
        table = distances(rows, pivots).astype("<i8")
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.tobytes() for t in table], pa.binary())],
                                         ["id", "parts", "to_pivots"])


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple]:
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        rows = _matrix(part.column(1), "<i4", centroids.shape[1])
        table = _matrix(part.column(2), "<i8", len(pivots))
        cluster, distance, _ = nearest(rows, table, centroids, pivots)
        yield part.column(0), rows, cluster, distance


def sum_batches(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray
                ) -> Iterator[pa.RecordBatch]:
    """Rows of ``pivot_batches`` in; (cluster, component, sum, rows) of a task's vectors out."""
    k, dims = centroids.shape
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        for _, rows, cluster, _ in _assigned(batch, centroids, pivots):
            for c in range(k):
                sums[c] += rows[cluster == c].sum(axis=0)
            counts += np.bincount(cluster, minlength=k)
    c, j = np.nonzero(np.broadcast_to(counts[:, None] > 0, (k, dims)))
    yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(j), pa.array(sums[c, j]), pa.array(counts[c])],
                                     ["cluster", "place", "total", "rows"])


def assign_batches(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray
                   ) -> Iterator[pa.RecordBatch]:
    """Rows of ``pivot_batches`` in; (id, cluster, squared distance) out."""
    for batch in batches:
        for ids, _, cluster, distance in _assigned(batch, centroids, pivots):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             ["id", "cluster", "distance"])
