"""Order-minhash sketches and banded alignment: the work inside one task, on numpy arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Words are runs of letters, digits and all bytes beyond ASCII, with A-Z made small.
_BYTES = np.arange(256)
_IS_WORD = ((_BYTES >= 48) & (_BYTES < 58) | (_BYTES >= 65) & (_BYTES < 91)
            | (_BYTES >= 97) & (_BYTES < 123) | (_BYTES >= 128))
_SMALL = np.where((_BYTES >= 65) & (_BYTES < 91), _BYTES + 32, _BYTES)
_TABLE = np.where(_IS_WORD, _SMALL, 32).astype(np.uint8).tobytes()

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
# Text is worked on in pieces of about this size; a longer document is one piece.
CHUNK_BYTES = 2_000_000


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after another, and the words per text."""
    n = len(data)
    text = np.frombuffer(data.tobytes().translate(_TABLE), np.uint8)
    inside = text != 32
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside & (edge[:n] | ~np.concatenate(([False], inside[:-1]))) if n else inside
    last = inside & (edge[1:] | ~np.concatenate((inside[1:], [False]))) if n else inside
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), n)
    hashes = _mix((sums[stop] - sums[start]) * inverse[start]) if len(start) else sums[:0]
    return hashes, np.diff(np.searchsorted(start, offsets))


def _kmers(hashes: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled hashes of all runs of k words, and their text; a shorter text is one run."""
    stops = np.cumsum(words)
    owner = np.repeat(np.arange(len(words)), words)
    place = np.arange(len(hashes))
    runs = np.zeros(len(hashes), np.uint64)
    for j in range(k):
        m = len(hashes) - j
        if m > 0:
            runs[:m] += hashes[j:] * np.uint64(pow(_BASE, j + 1, 1 << 64))
    whole = place + k <= stops[owner]
    for d in np.flatnonzero((words > 0) & (words < k)):
        s = stops[d] - words[d]
        runs[s] = sum(int(h) * pow(_BASE, j + 1, 1 << 64) for j, h in enumerate(hashes[s:stops[d]])) & _MASK
        whole[s] = True
    runs, owner = _mix(runs[whole]), owner[whole]
    # The label of a run is how often it came before in its text.
    own = _mix(runs + owner.astype(np.uint64) * np.uint64(_BASE))
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    index = np.arange(len(ranked))
    label = np.empty(len(ranked), np.uint64)
    label[order] = (index - np.maximum.accumulate(np.where(new, index, 0))).astype(np.uint64)
    return _mix(runs + label * np.uint64(0xC2B2AE3D27D4EB4F)), owner


def order_sketches(data: np.ndarray, offsets: np.ndarray, k: int, picks: int, sketches: int
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts that have words, words of each, one row of sketch values for each).

    Each sketch value is made of the ``picks`` labelled k-mers with the smallest hashes, in the
    order in which the text has them.
    """
    hashes, words = word_hashes(data, offsets)
    keys, owner = _kmers(hashes, words, k)
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, sketches), np.int64)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    sizes = np.diff(np.append(starts, len(owner)))
    out = np.empty((len(starts), sketches), np.int64)
    top = np.uint64(_MASK)
    for j in range(sketches):
        h = keys + np.uint64((j + 1) * 0xA0761D6478BD642F & _MASK)
        h = _mix(h)
        spots = np.empty((picks, len(starts)), np.int64)
        for i in range(picks):
            least = np.minimum.reduceat(h, starts)
            at = np.flatnonzero(h == np.repeat(least, sizes))
            spots[i] = at[np.searchsorted(at, starts)]
            h[spots[i]] = top
        # A text with fewer k-mers than picks has only those.
        spots[np.arange(picks)[:, None] >= sizes[None, :]] = len(keys)
        spots.sort(axis=0)
        values = np.append(keys, np.uint64(0))
        made = np.full(len(starts), j + 1, np.uint64)
        for i in range(picks):
            made = _mix(made * np.uint64(_BASE) + values[spots[i]])
        out[:, j] = made.view(np.int64)
    texts = owner[starts]
    return texts, words[texts], out


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(keys, bytes, offsets) of the texts of a batch, in pieces of bounded size."""
    keys = batch.column(0)
    text = batch.column(1).cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8) if offsets[-1] else np.zeros(0, np.uint8)
    at = 0
    while at < len(text):
        stop = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
        stop = min(max(stop, at + 1), len(text))
        own = offsets[at:stop + 1]
        yield keys.slice(at, stop - at), data[own[0]:own[-1]], own - own[0]
        at = stop


def sketch_batches(batches: Iterator[pa.RecordBatch], k: int, picks: int, sketches: int
                   ) -> Iterator[pa.RecordBatch]:
    """(key, text) in; (key, words, sketch) out for the texts that have words."""
    for batch in batches:
        for keys, data, offsets in _chunks(batch):
            texts, words, values = order_sketches(data, offsets, k, picks, sketches)
            yield pa.RecordBatch.from_arrays([
                keys.take(pa.array(texts)), pa.array(words, pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * sketches, pa.int32()),
                                         pa.array(values.ravel()))], ["_key", "_words", "_sketch"])


def run_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(key, text) in; (key, words, all occurrence-labelled runs of k words) out for the texts that have words."""
    for batch in batches:
        for keys, data, offsets in _chunks(batch):
            hashes, words = word_hashes(data, offsets)
            runs, owner = _kmers(hashes, words, k)
            texts, starts = np.unique(owner, return_index=True)
            yield pa.RecordBatch.from_arrays([
                keys.take(pa.array(texts)), pa.array(words[texts], pa.int64()),
                pa.LargeListArray.from_arrays(pa.array(np.append(starts, len(owner)), pa.int64()),
                                              pa.array(runs.view(np.int64))).cast(pa.list_(pa.int64()))],
                ["_key", "_words", "_runs"])


def counted_run_batches(batches: Iterator[pa.RecordBatch], k: int, more_than: int, among: np.ndarray | None
                        ) -> Iterator[pa.RecordBatch]:
    """(key, text) in; (run, how many of the task's texts have it) of the runs that more texts have.

    With ``among``, sorted, only those runs count. A run with its label is in a text once.
    """
    kept = []
    for batch in run_batches(batches, k):
        runs = np.asarray(batch.column(2).flatten())
        kept.append(runs if among is None else runs[np.isin(runs, among)])
    runs, counts = np.unique(np.concatenate(kept) if kept else np.zeros(0, np.int64), return_counts=True)
    many = counts > more_than
    yield pa.RecordBatch.from_arrays([pa.array(runs[many]), pa.array(counts[many])], ["_value", "_texts"])


def first_run_batches(batches: Iterator[pa.RecordBatch], k: int, common: np.ndarray, similarity: float,
                      alone: bool = False) -> Iterator[pa.RecordBatch]:
    """(key, text) in; (key, words, run, whether it is in ``common``) of the first runs of each text out.

    ``common`` is sorted. Common runs come last, otherwise runs are in order of their value. A task that is
    ``alone`` has all texts, so a run that is among the first of one of them only can link none and is left out.
    """
    made = _first_runs(batches, k, common, similarity)
    if not alone:
        yield from made
        return
    made = list(made)
    if made:
        runs, counts = np.unique(np.concatenate([b.column(2) for b in made]), return_counts=True)
        for b in made:
            yield b.filter(pa.array(counts[np.searchsorted(runs, b.column(2))] > 1))


def _first_runs(batches: Iterator[pa.RecordBatch], k: int, common: np.ndarray, similarity: float
                ) -> Iterator[pa.RecordBatch]:
    for batch in run_batches(batches, k):
        lists = batch.column(2)
        sizes = np.diff(np.asarray(lists.offsets))
        runs, owner = np.asarray(lists.flatten()), np.repeat(np.arange(len(sizes)), sizes)
        known = np.isin(runs, common)
        order = np.lexsort((runs, known, owner))
        place = np.arange(len(runs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = order[place < np.repeat(sizes - np.ceil(sizes * similarity - 1e-9).astype(np.int64) + 1, sizes)]
        at = pa.array(owner[order])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(runs[order]),
                                          pa.array(known[order])], ["_key", "_words", "_value", "_common"])


def aligned_distance(a: list, b: list, limit: int) -> int | None:
    """Edit distance of two word lists, or None beyond ``limit``.

    Only diagonals within ``limit`` of the main one are aligned. For each number of edits the
    furthest point on every diagonal of the band is kept, so near copies cost about their
    length plus the square of their distance.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    # Words that one side lacks need an edit each, whatever the alignment.
    if max(n, m) - (Counter(a) & Counter(b)).total() > limit:
        return None
    number: dict = {}
    a = [number.setdefault(w, len(number)) for w in a] + [-1]
    b = [number.setdefault(w, len(number)) for w in b] + [-2]
    goal = m - n
    far: dict[int, int] = {}
    for edits in range(limit + 1):
        now: dict[int, int] = {}
        for d in range(max(-edits, -limit), min(edits, limit) + 1):
            x = max(far.get(d, -2) + 1, far.get(d - 1, -2), far.get(d + 1, -2) + 1) if edits else 0
            if x > n:
                x = n
            y = x + d
            if x < 0 or y < 0 or y > m:
                continue
            while a[x] == b[y]:
                x += 1
                y += 1
            now[d] = x
        if now.get(goal, -1) >= n:
            return edits
        far = now
    return None


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def aligned_batches(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(a, b, text a, text b) in; the pairs (a, b) that are near enough out."""
    for batch in batches:
        near = []
        for i in range(batch.num_rows):
            one = words_of(batch.column(2)[i].as_py().encode())
            two = words_of(batch.column(3)[i].as_py().encode())
            limit = allowed_edits(max(len(one), len(two)), similarity)
            if aligned_distance(one, two, limit) is not None:
                near.append(i)
        chosen = pa.array(near, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen)],
                                         ["a", "b"])


def allowed_edits(words: int, similarity: float) -> int:
    """The most edits at which a text of so many words is still that similar."""
    return int((1 - similarity) * words + 1e-9)
