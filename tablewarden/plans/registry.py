"""Registry of queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tablewarden.plans.views import with_views
from tablewarden.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        from tablewarden.plans.views import VIEWS, view
        if name in VIEWS:
            return view(self, name)
        return read_table(self.spark, self.folder, name)


def query(sql: str | None = None, views: Sequence[str] = ()):
    """Register a function of ``Tables`` under its own name, with the checking SQL."""
    def register(make: Callable[[Tables], DataFrame]):
        name = make.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return make(Tables(spark, folder))
        run.__name__, run.__doc__ = name, make.__doc__
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return make
    return register
