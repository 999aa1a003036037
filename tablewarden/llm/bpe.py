"""Byte-level BPE encoding and decoding of texts by a rank file."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.common import Packed, in_small_batches
from tablewarden.llm.merges import decode_batches, encode_batches


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` and ``n_tokens``: the token ids of each text, 32 bits each, little end first.

    ``ranks`` is the path of a rank file that every executor can read (``base64 rank`` lines),
    ``pattern`` splits a text into the words that are merged separately. There are no special
    tokens. A NULL text is taken as empty and has no tokens. Each task takes texts up to a
    bounded size as a corpus, replays the merges over its distinct words in rank order and looks
    the words of each text up; a word remembered from an earlier corpus is not encoded again.
    """
    packed = Packed(docs)
    place = int(packed.named(text)[2:])
    encoded = in_small_batches(packed.df).mapInArrow(
        partial(encode_batches, path=ranks, pattern=pattern, place=place),
        T.StructType([*packed.df.schema.fields, T.StructField("_ids", T.BinaryType())]))
    return packed.unpack(encoded, [F.col("_ids"), (F.octet_length("_ids") / 4).cast("bigint")],
                         ["ids", "n_tokens"])


def decode(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``: the bytes that the ids stand for. NULL ids give no bytes."""
    packed = Packed(tokens)
    place = int(packed.named(ids)[2:])
    decoded = in_small_batches(packed.df).mapInArrow(
        partial(decode_batches, path=ranks, pattern=pattern, place=place),
        T.StructType([*packed.df.schema.fields, T.StructField("_decoded", T.BinaryType())]))
    return packed.unpack(decoded, [F.col("_decoded")], ["decoded"])


