"""The corpus pipeline: documents go through the stages in order, each stored and read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import bpe, decontamination, near_dedup, secrets
from tablewarden.llm import toxicity as toxic
from tablewarden.llm.training import training_rows
from tablewarden.sources.tables import read_table
from tablewarden.storage import materialize

TOXIC = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, finds toxic go."""
    lexicon = toxic.fit(training_rows(docs, read_table(spark, sf_dir, "labels"), "toxic"))
    scored = toxic.score(docs, lexicon)
    return scored.where(F.col("score") < TOXIC).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return near_dedup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words of a benchmark window go."""
    return decontamination.uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets; ``n_chars`` follows the text."""
    found = secrets.scan(docs)
    masked = found.withColumn("text", secrets.redact(F.col("text"), F.col("secrets")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.size("secrets") > 0, size)
                                   .otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are added, with whether decoding them gives the text back."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern)
    whole = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return decoded.withColumn("round_trip", whole).drop("decoded")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

# Fitting, sketches and merges have no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns for the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
