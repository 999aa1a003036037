"""Result values that compare equal across engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.ordered import MAX_GROUP_ROWS


def number(col: str | Column, places: int, name: str | None = None) -> Column:
    """A double rounded through decimal, so that the last bits of a sum do not show."""
    value = F.col(col) if isinstance(col, str) else col
    alias = name or (col if isinstance(col, str) else None)
    rounded = value.cast(f"decimal(18,{places})").cast("double")
    return rounded.alias(alias) if alias else rounded


def small_limit(df: DataFrame) -> int:
    """A group limit that splits groups in small tables too, and never exceeds the usual one."""
    return min(MAX_GROUP_ROWS, max(1, df.count() // 40))
