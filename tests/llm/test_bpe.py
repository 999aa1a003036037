import base64
import random
import struct

import public_tokenizers
import tiktoken

from tablewarden.llm import bpe
from tablewarden.llm.merges import Merges, parse_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def reference(ranks, pattern=PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def unpacked(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_texts_against_the_library(texts):
    ranks = parse_ranks(open(PATH, "rb").read())
    merges, want = Merges(ranks, PATTERN), reference(ranks)
    rng = random.Random(4)
    made = [*texts.values(), "", " ", "a" * 5000, "ab" * 3000 + "c", "   \n\n \t x", "<|endoftext|>", "don't 12 345",
            *["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x2FF), rng.randrange(0x4E00, 0x4F00),
                                      rng.randrange(0x1F600, 0x1F640)])) for _ in range(200)) for _ in range(50)]]
    for text, ids in zip(made, merges.encode(made), strict=True):
        assert unpacked(ids) == want.encode_ordinary(text)
        assert merges.decode(ids) == text.encode()


def test_ranks_that_fall_after_a_merge():
    """Merges can bring lower ranks about; the order inside each word then matters."""
    rng = random.Random(8)
    for _ in range(150):
        words = {bytes([b]) for b in range(256)}
        entries = {bytes(rng.choices(b"abc", k=rng.randrange(2, 6))) for _ in range(25)}
        order = rng.sample(sorted(entries), len(entries))
        ranks = {w: i for i, w in enumerate(sorted(words))} | {w: 256 + i for i, w in enumerate(order)}
        merges, want = Merges(ranks, r"\S+|\s+"), reference(ranks, r"\S+|\s+")
        text = " ".join("".join(rng.choices("abc", k=rng.randrange(1, 12))) for _ in range(40))
        assert unpacked(merges.encode([text])[0]) == want.encode_ordinary(text)


def test_a_cleared_memory_changes_nothing(monkeypatch, texts):
    monkeypatch.setattr("tablewarden.llm.merges.REMEMBERED", 10)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    merges, want = Merges(ranks, PATTERN), reference(ranks)
    for text in list(texts.values())[:20]:
        assert unpacked(merges.encode([text])[0]) == want.encode_ordinary(text)


def test_odd_documents_and_empty_tables(spark, odd, empty):
    encoded = bpe.encode(odd, PATH, PATTERN)
    assert len(encoded.columns) == len({c.lower() for c in encoded.columns})
    decoded = bpe.decode(encoded, PATH, PATTERN).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in decoded) and len(decoded) == odd.count()
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in decoded)
    assert bpe.decode(bpe.encode(empty, PATH, PATTERN), PATH, PATTERN).count() == 0


def test_a_corpus_spans_batches(monkeypatch):
    import pyarrow as pa

    from tablewarden.llm import merges
    rng = random.Random(3)
    texts = [None, ""] + ["".join(rng.choices("abc de\n", k=rng.randrange(90))) for _ in range(300)]
    batches = [pa.RecordBatch.from_pydict({"n": list(range(i, min(i + 7, 302))), "t": pa.array(texts[i:i + 7], pa.string())})
               for i in range(0, 302, 7)]
    vocabulary = merges.load(PATH, PATTERN)
    want = vocabulary.encode([t or "" for t in texts])
    sizes = []
    plain_encode = merges.Merges.encode
    monkeypatch.setattr(merges.Merges, "encode", lambda self, t: sizes.append(len(t)) or plain_encode(self, t))
    for chars, rows in ((1, 20), (50, 20_000), (1000, 20_000), (10**9, 40), (10**9, 20_000)):
        monkeypatch.setattr(merges, "CHUNK_CHARS", chars)
        monkeypatch.setattr(merges, "CHUNK_ROWS", rows)
        sizes.clear()
        made = list(merges.encode_batches(iter(batches), PATH, PATTERN, 1))
        assert [n for b in made for n in b.column("n").to_pylist()] == list(range(302))
        assert [x for b in made for x in b.column("_ids").to_pylist()] == want
        assert sum(sizes) == 302
        if chars == 1000:
            assert max(sizes) > 7
    assert sizes == [302]
    assert list(merges.encode_batches(iter([]), PATH, PATTERN, 1)) == []
