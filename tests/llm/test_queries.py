"""The registered queries of the subpackage against their SQL; those without SQL have tests of their own."""

import pytest

import __spark_entry__ as entry_points
import check
from tablewarden.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    verdict = check.compare(spark, check.duck(SMALL), SMALL, name)
    assert verdict.startswith("ok") and "differ" not in verdict, verdict


def test_names():
    numbers = sorted(int(n.split("_")[0][2:]) for n in QUERIES)
    assert numbers == list(range(1, 11))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
