"""Files of token ids, inside one task: documents compressed one by one with a shared dictionary.

A shard is

* the magic bytes and the SHA-256 of the dictionary (32 bytes),
* one zstandard frame per document over its ids (unsigned 32 bits, little end first),
* the offset index, a zstandard frame over three columns of 64-bit integers: document id, offset of
  the frame in the shard, number of ids; a last byte per document tells a NULL id,
* the length of the index frame and the number of documents (64 bits each), and the magic bytes,
* a line break, which the writer puts at the end of every file.

A document is read from its frame alone: the tail gives the index, the index the frame.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext

from tablewarden.llm.units import encoder, portions

MAGIC = b"TWIDS01\n"
_TAIL = 16 + len(MAGIC)
LEVEL = 3
# A shard ends with the document that brings its frames to this size.
SHARD_BYTES = 16_000_000
_OUT_BYTES = 16_000_000
# Characters that are cut into pieces at a time; what is made of them takes many times their length.
_GROUP_CHARS = 4_000_000


def digest_of(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary from serialized id arrays; their own bytes when they are too few to train on."""
    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _shared(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


class Compressor:
    def __init__(self, dictionary: bytes):
        self.frame = zstandard.ZstdCompressor(level=LEVEL, **_shared(dictionary)).compress


def slices_of(ids: pa.Array, bounds: np.ndarray, null_slices: int, salts: np.ndarray) -> np.ndarray:
    """The slice of each id in ascending order, NULLs in the negative slices before all.

    A value that is several of the ``bounds`` fills the slices between them; its rows are dealt out.
    """
    null = np.asarray(ids.is_null())
    values = np.asarray(ids.fill_null(0), np.int64)
    low, high = np.searchsorted(bounds, values, "left"), np.searchsorted(bounds, values, "right")
    own = np.where(high - low > 1, low + 1 + salts % np.maximum(high - low, 1), high)
    return np.where(null, -1 - salts % max(null_slices, 1), own)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches in order, so many at a time that their texts have about ``_GROUP_CHARS`` bytes."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.column(1).nbytes
        if size >= _GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_batches(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int | None, dictionary: bytes,
                   bounds: np.ndarray, null_slices: int) -> Iterator[pa.RecordBatch]:
    """(id, text) in; (slice, id, number of ids, frame) out.

    Small batches are encoded together: the more texts at a time, the fewer times a piece is looked up.
    """
    tool, frame = encoder(tokenizer), Compressor(dictionary).frame
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    seen = itertools.count(TaskContext.get().partitionId() if TaskContext.get() else 0)
    for group in _gathered(batches):
        idents = pa.concat_arrays([batch.column(0) for batch in group])
        salts = np.fromiter(itertools.islice(seen, len(idents)), np.int64, len(idents))
        texts = (t.as_py() or "" for batch in group for t in batch.column(1))
        counts, frames = [], []
        for part in portions(texts, _GROUP_CHARS):
            for ids in tool.encode(part):
                counts.append((len(ids) + len(end)) // 4)
                frames.append(frame(ids + end))
        yield pa.RecordBatch.from_arrays([
            pa.array(slices_of(idents, bounds, null_slices, salts), pa.int64()), idents,
            pa.array(counts, pa.int64()), pa.array(frames, pa.binary())], ["slice", "id", "n_tokens", "frame"])


class _Shard:
    """A shard that is being filled; ``before`` is the number of ids of its slice before it."""

    def __init__(self, digest: bytes, place: int, before: int):
        self.place, self.before = place, before
        self.parts, self.size, self.tokens = [MAGIC, digest], len(MAGIC) + len(digest), 0
        self.ids, self.offsets, self.counts = [], [], []

    def add(self, ident: int | None, count: int, frame: bytes) -> None:
        self.ids.append(ident)
        self.offsets.append(self.size)
        self.counts.append(count)
        self.parts.append(frame)
        self.size += len(frame)
        self.tokens += count

    def finish(self) -> pa.RecordBatch:
        known = [i for i in self.ids if i is not None]
        columns = np.array([[i or 0 for i in self.ids], self.offsets, self.counts], "<i8")
        index = zstandard.compress(columns.tobytes() + bytes(i is None for i in self.ids))
        tail = np.array([len(index), len(self.ids)], "<i8").tobytes() + MAGIC
        low, high = (min(known), max(known)) if known else (None, None)
        row = (self.place, self.before, self.tokens, low, high, b"".join([*self.parts, index, tail]))
        kinds = [pa.int64()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                          ["slice", "before", "tokens", "low", "high", "shard"])


def shard_batches(batches: Iterator[pa.RecordBatch], digest: str, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``encode_batches`` in order of slice and id in; a row per finished shard out."""
    shard = None
    for batch in batches:
        for i in range(batch.num_rows):
            place, ident, count, frame = (c[i].as_py() for c in batch.columns)
            if shard and (shard.place != place or shard.size >= shard_bytes):
                yield shard.finish()
                before = shard.before + shard.tokens if shard.place == place else 0
                shard = _Shard(bytes.fromhex(digest), place, before)
            shard = shard or _Shard(bytes.fromhex(digest), place, 0)
            shard.add(ident, count, frame)
    if shard:
        yield shard.finish()


def index_of(shard: memoryview, digest: str) -> tuple[list, np.ndarray, np.ndarray, int]:
    """(ids, offsets, counts, end of the frames) of a shard, after its marks were checked."""
    if bytes(shard[-1:]) != b"\n" or bytes(shard[:len(MAGIC)]) != MAGIC or bytes(shard[-1 - len(MAGIC):-1]) != MAGIC:
        raise ValueError("this is not a whole shard of token ids")
    if bytes(shard[len(MAGIC):len(MAGIC) + 32]).hex() != digest:
        raise ValueError("the shard was written with another dictionary")
    size, count = np.frombuffer(shard[-1 - _TAIL:-1 - len(MAGIC)], "<i8").tolist()
    at = len(shard) - 1 - _TAIL - size
    raw = zstandard.decompress(bytes(shard[at:at + size]))
    ids, offsets, counts = np.frombuffer(raw[:24 * count], "<i8").reshape(3, count)
    null = raw[24 * count:]
    return [None if n else i for i, n in zip(ids.tolist(), null, strict=True)], offsets, counts, at


def read_batches(batches: Iterator[pa.RecordBatch], dictionary: bytes, starts: dict[int, int],
                 wanted: frozenset[int] | None) -> Iterator[pa.RecordBatch]:
    """(slice, before, content) of shards in; (id, start, number of ids, ids) of their documents out.

    With ``wanted`` only the frames of those documents are decompressed.
    """
    unpack = zstandard.ZstdDecompressor(**_shared(dictionary)).decompress
    digest = digest_of(dictionary)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()),
                                            strict=True)], ["id", "start", "n_tokens", "ids"])
    for shards in batches:
        for i in range(shards.num_rows):
            place, before = shards.column(0)[i].as_py(), shards.column(1)[i].as_py()
            content = memoryview(shards.column(2)[i].as_buffer())
            ids, offsets, counts, end = index_of(content, digest)
            firsts = starts[place] + before + np.cumsum(counts) - counts
            stops = [*offsets[1:].tolist(), end]
            rows, size = [], 0
            for ident, at, stop, count, first in zip(ids, offsets.tolist(), stops, counts.tolist(),
                                                     firsts.tolist(), strict=True):
                if wanted is not None and ident not in wanted:
                    continue
                data = unpack(bytes(content[at:stop]), max_output_size=4 * count) if count else b""
                if len(data) != 4 * count:
                    raise ValueError("a document has another number of ids than the index says")
                rows.append((ident, first, count, data))
                size += len(data)
                if size > _OUT_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)
