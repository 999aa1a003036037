"""Byte-level BPE inside one task: merges replayed over a corpus of words."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex

# Texts are worked on together up to this size; a longer text is a corpus of its own.
CHUNK_CHARS = 2_000_000
# Very short texts are worked on together up to this number of rows.
CHUNK_ROWS = 20_000
# Encoded words that a task remembers; beyond this it starts anew.
REMEMBERED = 400_000

_SHIFT = 20


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64 rank``."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Merges:
    """A vocabulary of byte strings with ranks, which are also the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.first = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        if (self.first < 0).any():
            raise ValueError("every single byte needs a rank")
        self.pairs: dict[int, int] = {}
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                a, b = ranks.get(word[:i]), ranks.get(word[i:])
                if a is not None and b is not None:
                    self.pairs[a << _SHIFT | b] = rank
        self.bytes_of = {rank: word for word, rank in ranks.items()}
        self.known: dict[str, bytes] = {}
        get = self.pairs.get
        single = [ranks[bytes([i])] for i in range(256)]
        self.byte_pairs = np.array([[get(a << _SHIFT | b, -1) for b in single] for a in single],
                                   np.int64)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers.

        All words lie in one array with a gap after each. ``places`` is the inverted index: for
        each rank the positions where two neighbours make that rank. Ranks are taken in order
        and applied at all their positions from the left; only the two new neighbours of a merge
        are looked up. A merge can bring a lower rank about; that one then goes first and the
        rest of the current one waits, which is what merging each word alone would do.
        """
        joined = b"".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1)
        data = np.frombuffer(joined, np.uint8)
        spot = np.arange(len(data)) + np.repeat(np.arange(len(words)), lengths)
        size = int(stops[-1]) if len(words) else 0
        token = np.full(size + 1, -1, np.int64)
        token[spot] = self.first[data]
        rank = np.full(size + 1, -1, np.int64)
        if len(data) > 1:
            inner = spot[1:] == spot[:-1] + 1
            rank[spot[:-1][inner]] = self.byte_pairs[data[:-1][inner], data[1:][inner]]
        order = np.flatnonzero(rank >= 0)
        order = order[np.argsort(rank[order], kind="stable")]
        found, starts = np.unique(rank[order], return_index=True)
        places = {int(r): part.tolist() for r, part in zip(
            found, np.split(order, starts[1:]), strict=True)} if len(order) else {}
        tokens, after, before = token.tolist(), list(range(1, size + 2)), list(range(-1, size))
        pair = self.pairs.get
        queue = list(places)
        heapify(queue)
        while queue:
            r = heappop(queue)
            spots = places.pop(r, None)
            if spots is None:
                continue
            spots.sort()
            lower = False
            for i, p in enumerate(spots):
                a = tokens[p]
                if a < 0:
                    continue
                q = after[p]
                b = tokens[q]
                if b < 0 or pair(a << _SHIFT | b) != r:
                    continue
                s = after[q]
                tokens[p], tokens[q] = r, -2
                after[p] = s
                before[s] = p
                o = before[p]
                left, right = tokens[o] if o >= 0 else -1, tokens[s]
                for other, at in ((left << _SHIFT | r if left >= 0 else -1, o),
                                  (r << _SHIFT | right if right >= 0 else -1, p)):
                    new = pair(other)
                    if new is None:
                        continue
                    known = places.get(new)
                    if known is None:
                        places[new] = [at]
                        heappush(queue, new)
                    else:
                        known.append(at)
                    lower = lower or new < r
                if lower:
                    rest = spots[i + 1:]
                    if rest:
                        places[r] = rest + places.get(r, [])
                        heappush(queue, r)
                    break
        ids = np.array(tokens, np.int64)
        ids = ids[ids != -2]
        gaps = np.flatnonzero(ids < 0)
        packed = ids.astype("<u4").tobytes()
        made, at = [], 0
        for stop in gaps[:len(words)].tolist():
            made.append(packed[4 * at:4 * stop])
            at = stop + 1
        return made

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not remembered yet; a word that is an entry keeps its id."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = {w for w in words if w not in self.known}
        rest, raw = [], []
        for word in new:
            data = word.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[word] = rank.to_bytes(4, "little")
            else:
                rest.append(word)
                raw.append(data)
        if rest:
            self.known.update(zip(rest, self.replay(raw), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self.split(t) for t in texts]
        self.learn({w for p in parts for w in p})
        known = self.known
        return [b"".join([known[w] for w in p]) for p in parts]

    def decode(self, ids: bytes) -> bytes:
        words = self.bytes_of
        return b"".join([words[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Merges:
    """The vocabulary at ``path``, read once per worker process."""
    files, inner = pa.fs.FileSystem.from_uri(path)
    with files.open_input_stream(inner) as stream:
        return Merges(parse_ranks(stream.read()), pattern)


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, place: int
                   ) -> Iterator[pa.RecordBatch]:
    """Add ``_ids`` to all rows, from the text column at ``place``.

    Texts are gathered over batches, in order, until they make a corpus of ``CHUNK_CHARS``.
    """
    merges = load(path, pattern)

    def encoded(parts: list[pa.RecordBatch], texts: list[str]) -> Iterator[pa.RecordBatch]:
        ids, at = merges.encode(texts), 0
        for part in parts:
            own = pa.array(ids[at:at + part.num_rows], pa.binary())
            at += part.num_rows
            yield pa.RecordBatch.from_arrays([*part.columns, own], [*part.schema.names, "_ids"])

    parts, texts, size = [], [], 0
    for batch in batches:
        text, start = batch.column(place), 0
        for i in range(batch.num_rows):
            texts.append(text[i].as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK_CHARS:
                yield from encoded([*parts, batch.slice(start, i + 1 - start)], texts)
                parts, texts, size, start = [], [], 0, i + 1
        # The rest waits for later batches; rows without text are held to a number too.
        if start < batch.num_rows:
            parts.append(batch.slice(start))
        if len(texts) >= CHUNK_ROWS:
            yield from encoded(parts, texts)
            parts, texts, size = [], [], 0
    if texts:
        yield from encoded(parts, texts)


def decode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, place: int
                   ) -> Iterator[pa.RecordBatch]:
    """Add ``decoded`` to each batch, from its column of ids at ``place``."""
    merges = load(path, pattern)
    for batch in batches:
        decoded = pa.array([merges.decode(v.as_py() or b"") for v in batch.column(place)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "_decoded"])
