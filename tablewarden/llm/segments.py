"""Maximal scoring segments of token scores, and the lexicon that scores them, inside one task."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa

_WORD = re.compile(r"[^\W_]+")
# Lengths of word beginnings that stand in for words the lexicon lacks.
BEGINNINGS = (7, 5)
_FLUSH = 200_000
_REMEMBERED = 500_000


def tokens_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def terms_of(words: set[str]) -> set[str]:
    """Words, and the beginnings of longer ones marked with a star."""
    terms = set(words)
    for n in BEGINNINGS:
        terms.update(w[:n] + "*" for w in words if len(w) > n)
    return terms


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) in; (term, texts of class 1, texts of class 0) out, summed as far as fits."""
    toxic, clean = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        terms = list(toxic.keys() | clean.keys())
        batch = pa.RecordBatch.from_arrays([
            pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()),
            pa.array([clean[t] for t in terms], pa.int64())], ["_term", "_toxic", "_clean"])
        toxic.clear()
        clean.clear()
        return batch
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1), strict=True):
            terms = terms_of(set(tokens_of(text.as_py())))
            (toxic if label.as_py() else clean).update(terms)
            if len(toxic) + len(clean) > _FLUSH:
                yield flush()
    yield flush()


class _Scores(dict):
    """Scores of words by the lexicon, remembered up to a bound; 0 for other words."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) > _REMEMBERED:
            self.clear()
        score = self.lexicon.get(word)
        for n in BEGINNINGS:
            if score is None and len(word) > n:
                score = self.lexicon.get(word[:n] + "*")
        score = score or 0.0
        self[word] = score
        return score


def maximal_segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """(start, stop, score) of all maximal scoring segments, in linear time.

    ``hits`` are the positions with a positive score, in order; every other position scores
    ``-cost``. Each candidate remembers the nearest earlier one whose left sum is smaller, so a
    search for a partner walks over every candidate once before it is merged away.
    """
    found: list[list] = []  # left sum, right sum, start, stop, index of the nearest smaller left sum
    total, last = 0.0, -1
    for place, score in hits:
        total -= cost * (place - last - 1)
        last = place
        left, start = total, place
        total += score
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= total:
                found.append([left, total, start, place + 1, j])
                break
            left, start, below = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = below
    return [(s, e, r - l) for l, r, s, e, _ in found]


@dataclass
class Lexicon:
    """Scores of toxic terms, and what a segment's score means.

    ``decay`` and ``rate`` are the parameters of the extreme-value law: in ``n`` clean words
    about ``rate * n * exp(-decay * score)`` segments reach a score. ``intercept`` and ``slope``
    turn the evidence of a text into a chance.
    """

    scores: dict[str, float]
    cost: float
    decay: float = 1.0
    rate: float = 1.0
    intercept: float = 0.0
    slope: float = 1.0
    most_expected: float = 0.05
    memo: dict = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"memo": None}

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        if self.memo is None:
            self.memo = _Scores(self.scores)
        scores = list(map(self.memo.__getitem__, words))
        if not any(scores):
            return []
        return maximal_segments([(i, s) for i, s in enumerate(scores) if s], self.cost)

    def evidence(self, words: int, segments: list[tuple[int, int, float]]
                 ) -> tuple[float, list[tuple[int, int, float]]]:
        """Sum over the significant segments of the log of how rare they are, and these segments."""
        base = math.log(self.rate * max(words, 1))
        limit = -math.log(self.most_expected)
        rare = [s for s in segments if self.decay * s[2] - base >= limit]
        return sum(self.decay * s[2] - base for s in rare), rare


def measure_batches(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """(text, label) in; (label, words, segments, evidence in tenths) out, a row per text."""
    for batch in batches:
        rows = []
        for text in batch.column(0):
            words = tokens_of(text.as_py())
            segments = lexicon.segments(words)
            rows.append((len(words), len(segments), round(10 * math.log1p(lexicon.evidence(len(words), segments)[0]))))
        n, k, x = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([
            batch.column(1), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(x, pa.int64())],
            ["_label", "_words", "_segments", "_evidence"])


def _spans(text: str, rare: list[tuple[int, int, float]]) -> list[dict]:
    """Segments of words as segments of characters.

    Lower case can change the length of a text, so the words are found in the text as it is
    where that gives as many words, and in its lower case otherwise.
    """
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(tokens_of(text)):
        places = [m.span() for m in _WORD.finditer(text.lower())]
    return [{"start": places[s][0], "stop": places[e - 1][1], "score": v} for s, e, v in rare]


SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])


def score_batches(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, place: int
                  ) -> Iterator[pa.RecordBatch]:
    """Add the score and the toxic passages to each batch, from its text column at ``place``."""
    for batch in batches:
        scores, passages = [], []
        for value in batch.column(place):
            text = value.as_py() or ""
            words = tokens_of(text)
            x, rare = lexicon.evidence(len(words), lexicon.segments(words))
            scores.append(1 / (1 + math.exp(-max(-700.0, min(
                700.0, lexicon.intercept + lexicon.slope * math.log1p(x))))))
            passages.append(_spans(text, rare) if rare else [])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(scores, pa.float64()), pa.array(passages, pa.list_(SPAN))],
            [*batch.schema.names, "_score", "_passages"])
