"""Streams over files that arrive one load at a time."""

import pytest
from pyspark.sql import functions as F

from tablewarden.operators.cleaning import dedupe_keep
from tablewarden.sources import sinks
from tablewarden.sources.streams import (
    event_time, read_batches, sink_batches, stream_table)
from tablewarden.storage import new_path
from tablewarden.streaming import live, state
from tests.conftest import rows

SCHEMA = "id bigint, user int, ts timestamp_ntz, v int"


@pytest.fixture()
def loads(spark):
    """Writes one load of rows: (id, user, minute, v)."""
    folder = new_path(spark, "loads")

    def add(*data):
        df = spark.createDataFrame(list(data), "id bigint, user int, minute int, v int").selectExpr(
            "id", "user", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, minute) as ts", "v")
        df.write.mode("append").parquet(folder)
        return stream_table(spark, folder, "*.parquet", SCHEMA)
    return add


def test_new_files_only(spark, loads):
    path = new_path(spark, "sink")
    for i in range(3):
        sdf = loads((i, i, i, i), (i + 10, i, i, i))
        sink_batches(sdf, f"{path}/table", f"{path}/checkpoint")
    sink_batches(sdf, f"{path}/table", f"{path}/checkpoint")
    stored = read_batches(spark, f"{path}/table", SCHEMA)
    assert rows(stored, "id", "batch_id") == [(0, 0), (1, 1), (10, 0), (11, 1), (12, 2), (2, 2)]


def test_repeated_batch_replaces_itself(spark):
    from tablewarden.sources.streams import write_batch
    path = new_path(spark, "sink")
    for _ in range(2):
        write_batch(spark.range(5), 3, path)
        write_batch(spark.range(5, 7), 4, path)
    assert read_batches(spark, path, "id bigint").count() == 7


def test_dedupe_across_batches(spark, loads):
    path = new_path(spark, "sink")
    for load in ([(1, 1, 0, 1), (1, 1, 0, 1)], [(1, 1, 1, 1), (2, 1, 2, 1)], [(2, 1, 3, 1), (3, 1, 4, 1)]):
        once = live.stream_dedupe(event_time(loads(*load), "ts"), ["id"])
        sink_batches(once.select("id", "user", "v"), f"{path}/table", f"{path}/checkpoint")
    assert rows(read_batches(spark, f"{path}/table", "id bigint, user int, v int"), "id") == [(1,), (2,), (3,)]


def test_late_rows_set_aside(spark, loads):
    path = new_path(spark, "late")
    for load in ([(1, 1, 0, 1), (2, 1, 60, 1)], [(3, 1, 55, 1), (4, 1, 10, 1), (5, 1, 200, 1)],
                 [(6, 1, 100, 1), (7, 1, 195, 1)]):
        state.stream_late(loads(*load), path, f"{path}/checkpoint", 600)
    stored = read_batches(spark, f"{path}/rows", SCHEMA + ", late boolean")
    assert rows(stored.where("late"), "id") == [(4,), (6,)]
    assert rows(stored.where("not late"), "id") == [(1,), (2,), (3,), (5,), (7,)]


@pytest.mark.parametrize("fold_every", [1, 2, 50])
def test_upsert_keeps_newest(spark, loads, fold_every):
    path = new_path(spark, "upsert")
    data = []
    for i in range(5):
        load = [(10 * i + j, (i * j) % 4, i, i + j) for j in range(4)]
        data += load
        state.stream_upsert(loads(*load), path, ["user"], ["id"], f"{path}/checkpoint", fold_every)
    kept = state.read_upserted(spark, path, ["user"], ["id"])
    want = {}
    for id, user, _, v in data:
        want[user] = max(want.get(user, (-1, 0)), (id, v))
    assert {r["user"]: (r["id"], r["v"]) for r in kept.collect()} == want


@pytest.mark.parametrize("fold_every", [1, 2, 50])
def test_upsert_keeps_newest_when_older_rows_come_later(spark, loads, fold_every):
    path = new_path(spark, "upsert")
    for load in ([(10, 1, 10, 1), (3, 2, 3, 1)], [(5, 1, 5, 2), (4, 2, 4, 2)], [(10, 1, 10, 3), (2, 2, 2, 3)],
                 [(1, 1, 1, 4), (1, 3, 1, 4)]):
        state.stream_upsert(loads(*load), path, ["user"], ["id"], f"{path}/checkpoint", fold_every)
    kept = state.read_upserted(spark, path, ["user"], ["id"])
    assert rows(kept, "user", "id", "v") == [(1, 10, 3), (2, 4, 2), (3, 1, 4)]


def test_a_replayed_fold_keeps_the_base(spark, loads):
    path = new_path(spark, "upsert")
    for load in ([(1, 1, 1, 1)], [(2, 1, 2, 2)], [(3, 2, 3, 3)]):
        state.stream_upsert(loads(*load), path, ["user"], ["id"], f"{path}/checkpoint", 1)
    before = rows(state.read_upserted(spark, path, ["user"], ["id"]), "user", "id")
    for version in (1, 2, 2):
        sinks.publish(state._upserted(spark, path, ["user"], ["id"], version), f"{path}/base", version)
    assert rows(state.read_upserted(spark, path, ["user"], ["id"]), "user", "id") == before == [(1, 2), (2, 3)]
    assert sinks.current_version(spark, f"{path}/base", below=2) == 1


def test_enrich(spark, loads):
    dim = spark.createDataFrame([(1, "a")], "user int, name string")
    path = new_path(spark, "sink")
    joined = live.stream_enrich(loads((1, 1, 0, 0), (2, 2, 0, 0)), dim, ["user"])
    sink_batches(joined.select("id", "name"), f"{path}/table", f"{path}/checkpoint")
    assert rows(read_batches(spark, f"{path}/table", "id bigint, name string"), "id", "name") == [(1, "a"), (2, None)]


def test_partitions_replaced(spark):
    path = new_path(spark, "parts")
    sinks.write_partitions(spark.range(6).selectExpr("id", "id % 3 as p"), path, ["p"])
    sinks.write_partitions(spark.range(1).selectExpr("id + 100 as id", "1L as p"), path, ["p"])
    assert rows(spark.read.parquet(path), "id") == [(0,), (100,), (2,), (3,), (5,)]


def test_publish_and_read_version(spark):
    path = new_path(spark, "published")
    assert sinks.current_version(spark, path) is None
    sinks.publish(spark.range(3), path, 1)
    sinks.publish(spark.range(5), path, 2)
    assert sinks.current_version(spark, path) == 2 and sinks.read_published(spark, path).count() == 5


def test_dedupe_keep_in_batch_order(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, v int")
    assert rows(dedupe_keep(df, ["k"], ["-v"]), "k", "v") == [(1, 2), (2, 1)]
    assert df.agg(F.sum("v")).first()[0] == 4
