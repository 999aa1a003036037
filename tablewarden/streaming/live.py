"""Live metrics, sessions, repeats and lookups.

Each takes and returns a streaming DataFrame. The time column must be a TIMESTAMP (see
``sources.streams.event_time``); ``late`` is how long late rows are waited for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.monitoring import throughput


def stream_throughput(sdf: DataFrame, width: str, slide: str | None = None, late: str = "1 hour",
                      by: Sequence[str] = (), ts: str = "started_at") -> DataFrame:
    """Metrics per time bucket, the same as the batch form."""
    return throughput(sdf.withWatermark(ts, late), width, slide, by, ts)


def stream_sessions(sdf: DataFrame, gap: str, late: str = "1 hour", by: str = "session_id",
                    ts: str = "started_at") -> DataFrame:
    """Runs of entries with no pause of ``gap`` or more, given out once they are closed.

    With ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` set, as in
    ``session.SETTINGS``, entries are merged before the shuffle, so a very busy key sends
    sessions and not entries to its task.
    """
    return (sdf.withWatermark(ts, late).groupBy(by, F.session_window(ts, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("queries"), F.max(ts).alias("last_at"))
            .select(by, F.col("s.start").alias("first_at"), "last_at", "queries"))


def stream_dedupe(sdf: DataFrame, keys: Sequence[str], late: str = "1 hour", ts: str = "ts"
                  ) -> DataFrame:
    """First arrival of each key; repeats within ``late`` are dropped, the state is bounded."""
    return sdf.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def stream_enrich(sdf: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Look every entry up in a static table, read anew for each batch.

    The table is not marked for broadcast: it may grow while the stream runs, so Spark decides
    in each batch from its size.
    """
    return sdf.join(dim, list(on), how)
