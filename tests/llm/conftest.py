import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "pages", "conversations"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return c


@pytest.fixture(scope="session")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


# Rows that every operator on documents has to take: NULLs, empty and repeated texts, repeated and
# missing ids, and columns whose names the operators use themselves.
ODD_SCHEMA = ("doc_id bigint, text string, _key string, n_hit string, Score string, ids string, "
              "class_id string, secrets string, licenses string, _text int")


def odd_rows(text="One two three. Four five six."):
    rows = [(1, text), (1, text), (2, text), (3, ""), (4, ""), (5, None), (6, None), (None, text), (None, None),
            (7, "word " * 60_000), (8, "x" * 200_000), (9, "éß\U0001f600 \x00\n\n\t"), (10, " ")]
    return [(i, t, "k", "h", "s", "i", "c", "s", "l", 0) for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
