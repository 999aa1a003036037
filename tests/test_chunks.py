import shutil

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import chunks as C
from tablewarden.storage import new_path
from tests.conftest import rows

SCHEMA = "k long, v string"


def table(spark, n, changed=()):
    return spark.range(n).select(F.col("id").alias("k"), F.when(
        F.col("id").isin(*changed), "new").otherwise(F.col("id").cast("string")).alias("v"))


def test_one_changed_row_costs_one_chunk(spark):
    path = new_path(spark, "store")
    first, second = table(spark, 3000), table(spark, 3000, [1700])
    C.add_snapshot(first, path, ["k"], "a", 50)
    C.add_snapshot(second, path, ["k"], "b", 50)
    C.add_snapshot(second, path, ["k"], "c", 50)
    refs = C.references(spark, path)
    by_part = {r["part"]: r["n"] for r in refs.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert sorted(by_part.values())[:-1] == [1] and max(by_part.values()) > 30
    assert rows(C.read_snapshot(spark, path, "a")) == rows(first)
    assert rows(C.read_snapshot(spark, path, "b")) == rows(second)
    assert {r["snapshots"] for r in refs.collect()} == {1, 2, 3}


def test_added_and_deleted_rows_touch_their_neighbours_only(spark):
    a = C.chunks(table(spark, 3000), ["k"], 50)
    b = C.chunks(table(spark, 3000).where("k not in (10, 1500)"), ["k"], 50)
    assert b.join(a, "chunk_id", "left_anti").count() <= 4


def test_cut_in_slices(spark):
    plain = table(spark, 4000)
    assert rows(C.chunks(plain, ["k"], 40)) == rows(C.chunks(plain, ["k"], 40, max_rows=300))


def test_null_keys_equal_rows_and_wide_chunks(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x"), (1, None), (1, None), (1, None), (2, "")], SCHEMA)
    for size in (1, 2, 1000):
        path = new_path(spark, "store")
        C.add_snapshot(df, path, ["k"], "a", size)
        assert rows(C.read_snapshot(spark, path, "a")) == rows(df)


def test_empty_table_unknown_and_repeated_snapshots(spark):
    path = new_path(spark, "store")
    C.add_snapshot(spark.createDataFrame([], SCHEMA), path, ["k"], "none", 10)
    back = C.read_snapshot(spark, path, "none")
    assert back.count() == 0 and back.columns == ["k", "v"]
    with pytest.raises(ValueError):
        C.add_snapshot(table(spark, 5), path, ["k"], "none", 10)
    with pytest.raises(ValueError):
        C.read_snapshot(spark, path, "other")
    with pytest.raises(ValueError):
        C.add_snapshot(table(spark, 5).withColumn("part", F.lit(1)), path, ["k"], "b", 10)


def test_let_go_and_swept(spark):
    path = new_path(spark, "store")
    versions = {"a": table(spark, 2000), "b": table(spark, 2000, range(500)), "c": table(spark, 2500, range(500))}
    for name, df in versions.items():
        C.add_snapshot(df, path, ["k"], name, 25)
    assert C.sweep(spark, path).count() == 0
    C.expire(spark, path, ["a"])
    assert C.sweep(spark, path, 0.9).count() == 0
    done = C.sweep(spark, path).collect()
    assert len(done) == 1 and 400 < done[0]["dead_rows"] < 700
    refs = C.references(spark, path)
    assert refs.where("snapshots = 0").count() == 0
    stored = spark.read.parquet(f"{path}/parts").count()
    assert stored == refs.agg(F.sum("rows")).first()[0]
    for name in "bc":
        assert rows(C.read_snapshot(spark, path, name)) == rows(versions[name])


def test_after_broken_attempts(spark):
    path = new_path(spark, "store")
    df, later = table(spark, 1000), table(spark, 1000, [3])
    C.add_snapshot(df, path, ["k"], "a", 20)
    # An addition that ended before its manifest was complete.
    C.add_snapshot(later, path, ["k"], "b", 20)
    shutil.rmtree(f"{path}/manifest/snapshot=b")
    C.add_snapshot(later, path, ["k"], "b", 20)
    assert rows(C.read_snapshot(spark, path, "b")) == rows(later)
    # A sweep that ended before it removed the old part: its chunks stand twice.
    first = C.index(spark, path).groupBy("part").agg(F.count("*").alias("n")).orderBy("n").collect()[-1]["part"]
    for folder in ("parts", "index"):
        shutil.copytree(f"{path}/{folder}/part={first}", f"{path}/{folder}/part=z")
    assert rows(C.read_snapshot(spark, path, "a")) == rows(df)
    assert C.sweep(spark, path).select("part").collect()[0][0] == "z"
    assert rows(C.read_snapshot(spark, path, "a")) == rows(df)
    assert rows(C.read_snapshot(spark, path, "b")) == rows(later)


def test_what_is_laid_aside_is_short_and_moved_once(spark):
    """Hashes travel as bytes and numbers, and cuts are carried within a slice without another shuffle."""
    keyed = C.chunk_keys(table(spark, 4000), ["k"], 40, max_rows=300)
    assert dict(keyed.dtypes) == {"_key": "binary", "_a": "bigint", "_b": "bigint", "_first": "binary"}
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan
