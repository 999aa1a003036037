import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewarden.llm import id_files, token_ids, units
from tablewarden.llm.queries import QUERIES
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


PIECES = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", " ", "\x1c", "a", "B", "é", "ß", "1", "²", "٣", ".", "_",
          "-", "'s", "'ll", "漢", "\U0001f600", "<|endoftext|>", "word", "Ünder"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert units.encoder(PATH).encode([text]) == [plain(text)]


def test_a_small_memory_changes_nothing(monkeypatch, texts):
    monkeypatch.setattr(units, "PIECES", 20)
    monkeypatch.setattr(units, "WORDS", 30)
    tool, made = units.Encoder(units.read_text(PATH)), list(texts.values())[:40]
    for i in range(0, 40, 8):
        assert tool.encode(made[i:i + 8]) == [plain(t) for t in made[i:i + 8]]


def test_the_query_against_the_library(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op11_token_ids"](spark, SMALL).collect()}
    start = 0
    for ident in sorted(texts):
        ids = plain(texts[ident]) + (2).to_bytes(4, "little")
        row = got.pop(ident)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += row.n_tokens
    assert not got


@pytest.mark.parametrize("end", [2, None])
def test_odd_rows_come_back_in_order(spark, odd, end, monkeypatch):
    monkeypatch.setattr(token_ids, "SLICE_ROWS", 2)
    folder = token_ids.write_ids(odd, PATH, end_id=end)
    got = token_ids.read_ids(spark, folder).orderBy("start", "n_tokens").collect()
    tail = b"" if end is None else (2).to_bytes(4, "little")
    want = sorted(((r.doc_id, plain(r.text) + tail) for r in odd.collect()), key=repr)
    assert sorted(((r.id, bytes(r.ids)) for r in got), key=repr) == want
    ids = [r.id for r in got if r.n_tokens]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens


def test_one_id_of_many_rows_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(token_ids, "SLICE_ROWS", 50)
    ident = F.when(F.col("id") < 700, 5).when(F.col("id") < 900, None).otherwise(F.col("id"))
    docs = spark.range(1000).select(ident.alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    folder = token_ids.write_ids(docs, PATH, shard_bytes=600)
    shards = token_ids._files(spark, f"{folder}/shards")
    by_slice = shards.groupBy("slice").count().count()
    assert by_slice > 15 and shards.count() > by_slice
    got = token_ids.read_ids(spark, folder).orderBy("start").collect()
    assert sorted(bytes(r.ids) for r in got) == sorted(plain(f"text {i}") + b"\2\0\0\0" for i in range(1000))
    ids = [r.id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_single_documents_and_damage(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    folder = token_ids.write_ids(docs, PATH)
    whole = {r.id: r for r in token_ids.read_ids(spark, folder).collect()}
    few = random.Random(1).sample(sorted(texts), 3)
    got = token_ids.read_ids(spark, folder, [*few, -7]).collect()
    assert {r.id: r for r in got} == {i: whole[i] for i in few}
    content = bytes(token_ids._files(spark, f"{folder}/shards").select("content").first().content)
    digest = id_files.digest_of(token_ids.read_dictionary(spark, folder))
    id_files.index_of(memoryview(content), digest)
    for broken in (content[:-1], content[1:], b""):
        with pytest.raises(ValueError, match="not a whole shard"):
            id_files.index_of(memoryview(broken), digest)
    with pytest.raises(ValueError, match="another dictionary"):
        id_files.index_of(memoryview(content), "00" * 32)
    frames = sum(len(plain(t)) for t in texts.values())
    assert len(content) < 0.6 * frames


def test_an_empty_table(spark, empty):
    assert token_ids.read_ids(spark, token_ids.write_ids(empty, PATH)).collect() == []


def test_a_large_batch_is_encoded_in_bounded_groups(monkeypatch):
    taken = []

    class Tool:
        def encode(self, texts):
            taken.append(sum(map(len, texts)))
            return [plain(t) for t in texts]
    monkeypatch.setattr(id_files, "encoder", lambda path: Tool())
    made = ["word " * 300] * 2_000 + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int64()), pa.array(made, pa.string())], ["id", "text"])
    out = list(id_files.encode_batches(iter([batch]), PATH, 2, b"", np.array([], np.int64), 1))
    assert max(taken) <= id_files._GROUP_CHARS + 1_500 and sum(taken) == 2_000 * 1_500
    assert out[0].column("n_tokens").to_pylist() == [len(plain(t)) // 4 + 1 for t in made]


def test_small_batches_are_encoded_together(monkeypatch):
    taken = []

    class Tool:
        def encode(self, texts):
            taken.append(len(texts))
            return [plain(t) for t in texts]
    monkeypatch.setattr(id_files, "encoder", lambda path: Tool())
    made = [["a word", None], [], ["", "two words"], ["a word"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(len(m)), pa.int64()), pa.array(m, pa.string())], ["id", "text"])
               for m in made]
    out = pa.Table.from_batches(id_files.encode_batches(iter(batches), PATH, 2, b"", np.array([], np.int64), 1))
    assert taken == [5]
    assert out["id"].to_pylist() == [0, 1, 0, 1, 0]
    assert out["n_tokens"].to_pylist() == [len(plain(t)) // 4 + 1 for m in made for t in m]


def test_plain_words_go_to_the_model_once():
    tool, asked = units.Encoder(units.read_text(PATH)), []

    class Model:
        def tokenize(self, word, tokenize=tool.model.tokenize):
            asked.append(word)
            return tokenize(word)
    tool.library, tool.model = None, Model()
    made = ["Ünder wörds, and marks (two).\n\nIt's 12 wörds"] * 50 + ["wörds and wörds and"]
    assert tool.encode(made) == [plain(t) for t in made] and tool.encode(made) == [plain(t) for t in made]
    assert len(asked) == len(set(asked))


def test_every_plain_character_by_every_neighbour():
    plain_ones = [chr(i) for i in range(0x250) if units._PLAIN(chr(i))]
    made = [f"{a}{c}{b}" for c in plain_ones for a in ("", "x", "x ", "'", "1") for b in ("", "y", " y", "'s", ".", "2")]
    assert units.Encoder(units.read_text(PATH)).encode(made) == [plain(t) for t in made]


def test_texts_with_loose_blanks_lie_among_others():
    made = ["a b", "a  b c", "", " a b", "a b ", "a \nb c", "\x1c a", "漢 字", "漢  字", "x<|endoftext|> y z", "a b"]
    tool = units.Encoder(units.read_text(PATH))
    for _ in range(2):
        assert tool.encode(made) == [plain(t) for t in made]
