import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tablewarden.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g", name="tablewarden-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tablewarden.plans.registry import Tables
    return Tables(spark, SMALL)


def rows(df, *columns):
    df = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in df.collect()), key=repr)
