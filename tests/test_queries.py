"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
import check
from tablewarden.plans.catalogue import ORACLES, QUERIES
from tests.conftest import SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return check.duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    verdict = check.compare(spark, con, SMALL, name)
    assert verdict.startswith("ok") and "differ" not in verdict, verdict


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["segment", "orders", "revenue"] and df.count() == 5


def test_oracles_have_queries():
    assert set(ORACLES) == set(NAMES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(NAMES) <= set(entry_points.queries())
