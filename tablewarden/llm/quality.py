"""Text quality by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.common import Packed, in_small_batches
from tablewarden.llm.statistics import (
    NAMES, Discriminant, moment_batches, ratio_batches, score_batches)
from tablewarden.llm.training import logistic

SHRINK = 0.1
RIDGE = 0.01


def fit(training: DataFrame, shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant:
    """Fit on stored training rows (``_text``, ``_label``).

    The tasks send sums and outer products per class, a few hundred numbers in all. A class
    without rows gets the pooled covariance and a mean of 0, and its prior makes it unlikely; without
    any rows both classes are alike and every score is one half.
    """
    rows = in_small_batches(training.select("_text", "_label"))
    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d))
    sums = (rows.mapInArrow(moment_batches, "_label int, _entry int, _value double")
            .groupBy("_label", "_entry").agg(F.sum("_value").alias("_value")).collect())
    for r in sums:
        total[r["_label"], r["_entry"]] = r["_value"]
    model = Discriminant.of(total[:, 0], total[:, 1:1 + d], total[:, 1 + d:].reshape(2, d, d),
                            shrink, ridge)
    # The ratios are logarithms in tenths, so there are a few hundred values at most.
    points = (rows.mapInArrow(partial(ratio_batches, model=model), "_label int, _ratio bigint")
              .groupBy("_ratio").agg(F.sum(1 - F.col("_label")), F.sum("_label")).collect())
    model.intercept, model.slope = logistic([(r[0] / 10, r[1], r[2]) for r in points])
    return model


def score(docs: DataFrame, model: Discriminant, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher for better texts). A NULL text is scored as an empty one."""
    packed = Packed(docs)
    schema = T.StructType([*packed.df.schema.fields, T.StructField("_score", T.DoubleType())])
    scored = in_small_batches(packed.df).mapInArrow(
        partial(score_batches, model=model, place=int(packed.named(text)[2:])), schema)
    return packed.unpack(scored, [F.col("_score")], ["score"])
