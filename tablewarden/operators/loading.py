"""Loading into existing tables and keeping their history.

Plain Parquet has no row updates, so every function returns the new state of the table;
the caller writes it to a new path (see ``sources.sinks``). The joins here have unique
keys on both sides, and the batch side is broadcast by Spark when its files are small, in
which case the large target is not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tablewarden.operators.quality import Rules, failed_rules
from tablewarden.storage import materialize


def load_new(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the batch rows whose key is new."""
    return target.unionByName(batch.join(target.select(*keys), list(keys), "left_anti"))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace target rows of the same key; the others are added."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def latest_changes(feed: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Newest change per key, by an aggregate that keeps one row per key and task."""
    rest = [c for c in feed.columns if c not in (*keys, seq)]
    return (feed.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_row"))
            .select(*keys, "_row.*"))


def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str], seq: str,
                  op: str = "op") -> DataFrame:
    """Apply an ordered feed of inserts (I), updates (U) and deletes (D).

    ``seq`` orders the changes of a key and is unique within it. Target rows without a
    change pass through.
    """
    # Stored, because it says both which rows go and which come.
    newest = materialize(latest_changes(feed, keys, seq), "newest_changes")
    live = newest.where(F.col(op) != "D").select(*target.columns)
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(live)


def _at(at: str | Column) -> Column:
    return (F.lit(at) if isinstance(at, str) else at).cast("timestamp_ntz")


def open_history(df: DataFrame, at: str | Column) -> DataFrame:
    """First load: every row is valid from ``at``, with no end."""
    return df.withColumns({"valid_from": _at(at), "valid_to": F.lit(None).cast("timestamp_ntz")})


def history(target: DataFrame, batch: DataFrame, keys: Sequence[str], at: str | Column
            ) -> DataFrame:
    """Bring a versioned history up to the full state in ``batch``.

    Changed and missing keys are closed at ``at``; changed and new keys get an open row.
    Only open rows take part in the join; a table partitioned by whether a row is closed
    passes its closed part through unread by it.
    """
    keys = list(keys)
    attributes = [c for c in batch.columns if c not in keys]
    closed = target.where(F.col("valid_to").isNotNull())
    opened = target.where(F.col("valid_to").isNull()).select(
        *keys, F.struct(*attributes).alias("_old"), "valid_from")
    arrived = batch.select(*keys, F.struct(*attributes).alias("_new"))
    both = opened.join(arrived, keys, "full_outer")
    same = F.col("_old").eqNullSafe(F.col("_new"))
    none = F.lit(None).cast("timestamp_ntz")
    versions = F.array_compact(F.array(
        F.when(F.col("_old").isNotNull(), F.struct(
            F.col("_old").alias("row"), F.col("valid_from"),
            F.when(~same, _at(at)).otherwise(none).alias("valid_to"))),
        F.when(F.col("_new").isNotNull() & ~same, F.struct(
            F.col("_new").alias("row"), _at(at).alias("valid_from"), none.alias("valid_to")))))
    current = both.select(*keys, F.inline(versions)).select(
        *keys, "row.*", "valid_from", "valid_to")
    return closed.unionByName(current)


def history_of(versions: Sequence[tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """History from full states with the times they became valid, oldest first.

    One pass: the states are stacked with their number and each row is compared with its
    neighbours, so a key takes one small group of at most one row per state. Every state is
    read once and shuffled once, however many there are.
    """
    keys = list(keys)
    attributes = [c for c in versions[0][0].columns if c not in keys]
    last = len(versions) - 1
    stacked = None
    for i, (state, _) in enumerate(versions):
        part = state.select(*keys, F.struct(*attributes).alias("_row"), F.lit(i).alias("_state"))
        stacked = part if stacked is None else stacked.unionByName(part)
    times = F.array(*[_at(at) for _, at in versions])
    order = Window.partitionBy(*keys).orderBy("_state")

    def follows(row: Column, state: Column, earlier_row: Column, earlier_state: Column) -> Column:
        return F.coalesce((state == earlier_state + 1) & row.eqNullSafe(earlier_row), F.lit(False))
    row, state = F.col("_row"), F.col("_state")
    begins = ~follows(row, state, F.lag("_row").over(order), F.lag("_state").over(order))
    ends = ~follows(F.lead("_row").over(order), F.lead("_state").over(order), row, state)
    until = F.when(state < last, F.get(times, state + 1))
    marked = stacked.select(*keys, "_row", "_state", begins.alias("_begins"),
                            F.when(ends, F.struct(until.alias("at"))).alias("_end"))
    stop = F.first("_end", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    return (marked.withColumn("_stop", stop).where("_begins")
            .select(*keys, "_row.*", F.get(times, state).alias("valid_from"),
                    F.col("_stop.at").alias("valid_to")))


def as_of(history_table: DataFrame, at: str | Column) -> DataFrame:
    """The state that was valid at a time."""
    t = _at(at)
    return history_table.where(
        (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))
    ).drop("valid_from", "valid_to")


def load_since(df: DataFrame, col: str, mark: object) -> DataFrame:
    """Rows beyond the high-water mark.

    The mark becomes a literal of the column's own type, so the filter reaches the scan.
    """
    return df.where(F.col(col) > F.lit(mark).cast(df.schema[col].dataType))


def high_mark(df: DataFrame, col: str) -> DataFrame:
    """The new high-water mark, as one row."""
    return df.agg(F.max(col).alias("mark"))


def audit(df: DataFrame, rules: Rules, run_id: str, path: str) -> DataFrame:
    """Write accepted and rejected rows apart and report what was read and written.

    The rows read are observed while the write runs; the written ones are counted from the
    files. ``complete`` tells whether the two agree.
    """
    seen = Observation(f"audit {run_id}")
    tagged = df.observe(seen, F.count(F.lit(1)).alias("rows_read")).withColumn(
        "failed_rules", failed_rules(rules))
    (tagged.withColumn("accepted", F.size("failed_rules") == 0)
     .write.partitionBy("accepted").parquet(path))
    read = F.lit(seen.get["rows_read"]).cast("bigint")
    written = df.sparkSession.read.parquet(path)
    return written.agg(F.count_if("accepted").alias("accepted"),
                       F.count_if(~F.col("accepted")).alias("rejected"),
                       F.count(F.lit(1)).alias("written")).select(
        F.lit(run_id).alias("run_id"), read.alias("read"), "accepted", "rejected", "written",
        (read == F.col("written")).alias("complete"))
