"""What the classifiers share: bounded training rows and a logistic calibration."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import materialize

# Classifiers are fitted on about this many labelled rows at most.
MAX_TRAINING_ROWS = 40_000
FOLDS = 5


def held_out(ident: str | Column) -> Column:
    """Rows kept from training: a fixed fifth by the CRC of the id. FALSE for a NULL id."""
    return F.coalesce(F.crc32(F.col(ident).cast("string") if isinstance(ident, str)
                              else ident.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, ident: str = "doc_id",
                  text: str = "text", bound: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Stored (_text, _label) of labelled documents outside the held-out fold.

    Rows with a NULL id, label or text are left out; of several labels of an id the largest
    counts. When there are more than ``bound`` labelled ids, a share of them is taken by the
    hash of the id, so that about ``bound`` remain: the fit costs the same at every size.
    """
    known = labels.select(F.col(ident).alias("_id"), (F.col(label) > 0).cast("int").alias("_label")) \
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out("_id"))
    known = materialize(known.groupBy("_id").agg(F.max("_label").alias("_label")), "labels")
    count = known.count()
    if count > bound:
        place = F.pmod(F.xxhash64("_id"), F.lit(1 << 20))
        known = known.where(place < int((1 << 20) * bound / count))
    # About ``bound`` rows of two numbers.
    rows = docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text")) \
        .where(F.col("_text").isNotNull()).join(F.broadcast(known), "_id")
    return materialize(rows.select("_text", "_label"), "training_rows")


def logistic(points: list[tuple[float, float, float]], steps: int = 50) -> tuple[float, float]:
    """(intercept, slope) of P(1 | x) for (x, rows of class 0, rows of class 1).

    A small ridge keeps the slope finite when x separates the classes, and half a row of either
    class keeps the intercept finite when one is missing. No points give an even chance.
    """
    points = [*points, (0.0, 0.5, 0.5)]
    a = b = 0.0
    for _ in range(steps):
        g0, g1, h00, h01, h11 = 0.0, 1e-3 * b, 1e-9, 0.0, 1e-3
        for x, zeros, ones in points:
            p = sigmoid(a + b * x)
            n = zeros + ones
            g0 += n * p - ones
            g1 += (n * p - ones) * x
            w = n * p * (1 - p)
            h00 += w
            h01 += w * x
            h11 += w * x * x
        det = h00 * h11 - h01 * h01
        if abs(det) < 1e-300:
            break
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = max(1.0, abs(da) / 2, abs(db) / 2)
        a, b = a - da / scale, b - db / scale
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def sigmoid(v: float) -> float:
    return 1 / (1 + math.exp(-v)) if v >= 0 else math.exp(v) / (1 + math.exp(v))
