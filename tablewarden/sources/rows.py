"""Parsing text columns into typed columns, with what does not parse kept aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_rows(df: DataFrame, col: str, schema: str, bad: str = "bad_line", sep: str = ","
               ) -> DataFrame:
    """Split delimited lines into the columns of ``schema``.

    A line that does not fit keeps what could be read and its whole text in ``bad``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "sep": sep}
    parsed = F.from_csv(col, f"{schema}, {bad} string", options)
    return df.withColumn("_parsed", parsed).select(
        *[c for c in df.columns if c != col], "_parsed.*")


def parse_json(df: DataFrame, col: str, schema: str, bad: str = "bad_json") -> DataFrame:
    """Read the JSON objects in ``col`` into the columns of ``schema``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parsed = F.from_json(col, f"{schema}, {bad} string", options)
    return df.withColumn("_parsed", parsed).select(
        *[c for c in df.columns if c != col], "_parsed.*")
