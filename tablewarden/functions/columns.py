"""Column expressions for cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value.
NULL_TOKENS = ("", "N/A")


def tidy_text(col: Column, case: str | None = None) -> Column:
    """Trim, collapse inner white space, and set the case (lower, upper or None)."""
    tidy = F.trim(F.regexp_replace(col, r"\s+", " "))
    if case is None:
        return tidy
    return {"lower": F.lower, "upper": F.upper}[case](tidy)


def null_if_token(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def parse_any_date(col: Column, formats: Sequence[str]) -> Column:
    """First format that fits; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats]).cast("date")


def money(col: Column | str, precision: int = 12) -> Column:
    """A double amount as exact decimal with two places."""
    return (F.col(col) if isinstance(col, str) else col).cast(T.DecimalType(precision, 2))


def surrogate_key(columns: Sequence[str]) -> Column:
    """Stable key from the named columns; NULL and the empty text differ."""
    return F.md5(canonical_row(columns))


def canonical_row(columns: Sequence[str]) -> Column:
    """One text per row: fixed column order, length-prefixed values, a mark for NULL.

    The length prefix keeps ('a|b', 'c') and ('a', 'b|c') apart.
    """
    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.concat_ws("|", *[part(c) for c in columns])
