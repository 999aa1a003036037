"""Chat formatting with cumulative snapshots collapsed.

A log may hold a conversation again and again while it grows. A rolling hash over the turns of
each conversation gives a hash for every prefix; a conversation whose whole hash is a proper
prefix of another one is an earlier snapshot and is left out by an anti-join. What remains is
rendered as one text. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import materialize

# The marks around a turn.
TURN_START = "<|"
ROLE_END = "|>\n"
TURN_END = "<|end|>\n"
NO_ROLE = "unknown"


def _turn_hash(seed: int, place: Column) -> Column:
    return F.xxhash64(F.lit(seed), place, "_role", "_text")


def _sum(value: Column) -> Column:
    """A sum of 64-bit hashes that cannot overflow: decimals of 38 digits."""
    return F.sum(value.cast("decimal(20,0)"))


def maximal(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Stored turns of the maximal conversations: ``_conv, _own, _place, _role, _text``.

    The hash of a prefix is the sum over its turns of two 64-bit hashes of place, role and text,
    so it rolls on by one addition per turn. Rows are ordered by turn, then role and text, so that
    ties are settled. Of equal conversations the one with the smallest id stays. A turn with a NULL
    id belongs to no other turn: it is a conversation of its own, told apart by ``_own`` (NULL for
    turns with an id), so such turns never meet in one task. A NULL role is ``unknown``, a NULL text
    empty, a NULL turn comes first; repeated rows are turns of their own.
    """
    rows = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit(NO_ROLE)).alias("_role"),
                        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    known = rows.where(F.col("_conv").isNotNull())
    order = Window.partitionBy("_conv").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    known = known.withColumn("_place", F.row_number().over(order))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    known = known.select("_conv", F.lit(None).cast("string").alias("_own"), "_place", "_role", "_text",
                         _sum(_turn_hash(1, F.col("_place"))).over(upto).alias("_one"),
                         _sum(_turn_hash(2, F.col("_place"))).over(upto).alias("_two"),
                         F.count(F.lit(1)).over(Window.partitionBy("_conv")).alias("_size"))
    # Equal turns without an id are equal conversations, of which one stays.
    single = rows.where(F.col("_conv").isNull()).select("_conv", "_role", "_text").distinct()
    hashes = [_turn_hash(k, F.lit(1)).cast(known.schema[n].dataType) for k, n in ((1, "_one"), (2, "_two"))]
    single = single.select("_conv", F.concat_ws(":", *hashes).alias("_own"), F.lit(1).alias("_place"),
                           "_role", "_text", hashes[0].alias("_one"), hashes[1].alias("_two"),
                           F.lit(1).cast("bigint").alias("_size"))
    rows = materialize(known.unionByName(single), "chat_prefixes")
    whole = (rows.where(F.col("_place") == F.col("_size"))
             .groupBy("_place", "_one", "_two").agg(
                 F.min(F.struct(F.col("_conv").isNull(), "_conv", "_own")).alias("_first")))
    proper = (rows.where(F.col("_place") < F.col("_size"))
              .select("_place", "_one", "_two").distinct())
    kept = (whole.join(proper, ["_place", "_one", "_two"], "left_anti")
            .select(F.col("_first._conv").alias("_kept"), F.col("_first._own").alias("_kept_own")))
    kept = materialize(kept, "chat_kept")
    return rows.join(kept, F.col("_conv").eqNullSafe(F.col("_kept"))
                     & F.col("_own").eqNullSafe(F.col("_kept_own")), "left_semi") \
        .select("_conv", "_own", "_place", "_role", "_text")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per maximal conversation: its id, ``n_turns`` and the rendered ``chat``.

    A conversation is one row of the result, so its turns meet in one task; each turn without an id
    is a conversation of one turn, whose id is NULL (see ``maximal``). Other columns are not part of
    the result, whatever their names. An empty table gives no rows.
    """
    rendered = F.concat(F.lit(TURN_START), F.col("_role"), F.lit(ROLE_END), F.col("_text"),
                        F.lit("\n" + TURN_END))
    chats = (maximal(turns, conv, turn, role, text)
             .groupBy("_conv", "_own").agg(F.count(F.lit(1)).alias("n_turns"), F.sort_array(
                 F.collect_list(F.struct("_place", rendered.alias("_part")))).alias("_parts")))
    return chats.select(F.col("_conv").alias(conv), "n_turns",
                        F.array_join(F.col("_parts._part"), "").alias("chat"))
