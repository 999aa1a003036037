"""Toxicity by maximum-scoring segments of token log-odds.

Fitting counts in how many training texts of each class a term occurs and takes its log-odds
under a Dirichlet prior; terms whose log-odds stand out become a lexicon of positive scores, all
other words cost a little. In a text, every maximal scoring segment is found in one linear scan.
Scores of segments in clean text follow an extreme-value law, whose decay comes from the scores'
frequencies and whose rate from clean training texts; rare segments are toxic passages. Their
summed evidence is turned into a chance by a logistic fit on the training texts.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.common import Packed, in_small_batches, materialize
from tablewarden.llm.segments import (
    Lexicon, count_batches, measure_batches, score_batches)
from tablewarden.llm.training import logistic

PRIOR = 500.0
LEAST_Z = 3.3
MAX_TERMS = 20_000
COST = 0.2
MIN_ODDS = 1.0


def fit(training: DataFrame, prior: float = PRIOR, least_z: float = LEAST_Z,
        max_terms: int = MAX_TERMS, cost: float = COST) -> Lexicon:
    """A lexicon from stored training rows (``_text``, ``_label``).

    ``max_terms`` bounds the model: of more terms that stand out, those with the highest z stay.
    Without rows of both classes the lexicon is empty, and every text gets the share of class 1
    (an even chance without rows).
    """
    sizes = {r[0]: r[1] for r in training.groupBy("_label").count().collect()}  # two rows
    counts = (in_small_batches(training.select("_text", "_label"))
              .mapInArrow(count_batches, "_term string, _toxic bigint, _clean bigint")
              .groupBy("_term").agg(F.sum("_toxic").alias("_toxic"), F.sum("_clean").alias("_clean")))
    counts = materialize(counts, "term_counts")
    n_toxic, n_clean = counts.agg(F.coalesce(F.sum("_toxic"), F.lit(0)),
                                  F.coalesce(F.sum("_clean"), F.lit(0))).first()
    scores: dict[str, float] = {}
    decay = 1.0
    if n_toxic and n_clean:
        # Half a text for every term, and the rest of the prior by how common a term is.
        pseudo = 0.5 + prior * (F.col("_toxic") + F.col("_clean")) / (n_toxic + n_clean)
        one, two = F.col("_toxic") + pseudo, F.col("_clean") + pseudo
        odds = F.log(one / (n_toxic + prior - one)) - F.log(two / (n_clean + prior - two))
        z = odds / F.sqrt(1 / one + 1 / two)
        chosen = (counts.select("_term", odds.alias("_odds"), z.alias("_z"),
                                (two / (n_clean + prior)).alias("_share"))
                  .where((F.col("_z") >= least_z) & (F.col("_odds") >= MIN_ODDS))
                  .orderBy(F.desc("_z"), "_term").limit(max_terms).collect())
        scores = {r["_term"]: r["_odds"] for r in chosen}
        decay = _decay([(r["_share"], r["_odds"]) for r in chosen], cost)
    lexicon = Lexicon(scores, cost, decay)
    rows = in_small_batches(training.select("_text", "_label"))
    if scores:
        # How often clean words start a segment sets the rate of the law.
        measured = rows.where("_label = 0").mapInArrow(
            partial(measure_batches, lexicon=lexicon),
            "_label int, _words bigint, _segments bigint, _evidence bigint")
        words, segments = measured.agg(F.coalesce(F.sum("_words"), F.lit(0)),
                                       F.coalesce(F.sum("_segments"), F.lit(0))).first()
        lexicon.rate = (segments + 0.5) * math.exp(decay * MIN_ODDS) / (words + 1)
        points = (rows.mapInArrow(partial(measure_batches, lexicon=lexicon),
                                  "_label int, _words bigint, _segments bigint, _evidence bigint")
                  .groupBy("_evidence").agg(F.sum(1 - F.col("_label")), F.sum("_label")).collect())
        # The evidence is a logarithm in tenths, so there are a few hundred values at most.
        lexicon.intercept, lexicon.slope = logistic([(r[0] / 10, r[1], r[2]) for r in points])
    else:
        ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
        lexicon.intercept, lexicon.slope = math.log((ones + 0.5) / (zeros + 0.5)), 0.0
    return lexicon


def _decay(terms: list[tuple[float, float]], cost: float) -> float:
    """The positive root of sum(p * exp(decay * score)) = 1 over the scores of clean words."""
    rest = max(0.0, 1 - sum(p for p, _ in terms))

    def excess(v: float) -> float:
        return sum(p * math.exp(min(700.0, v * s)) for p, s in terms) + rest * math.exp(-v * cost) - 1
    low, high = 1e-6, 1.0
    if not terms or excess(low) >= 0:
        return 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``passages`` to each document.

    A passage has its first character, the one after its last, and its score in log-odds. A NULL
    or empty text has no passages and the score of a text without evidence.
    """
    packed = Packed(docs)
    passages = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
        T.StructField("score", T.DoubleType())]))
    schema = T.StructType([*packed.df.schema.fields, T.StructField("_score", T.DoubleType()),
                           T.StructField("_passages", passages)])
    scored = in_small_batches(packed.df).mapInArrow(
        partial(score_batches, lexicon=lexicon, place=int(packed.named(text)[2:])), schema)
    return packed.unpack(scored, [F.col("_score"), F.col("_passages")], ["score", "passages"])
