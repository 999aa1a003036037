"""Statistics of a text, and the discriminant that scores them, inside one task."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes beyond ASCII count as letters: nearly all of them are parts of letters.
_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES < 91)
_LETTER = _UPPER | (_CODES >= 97) & (_CODES < 123) | (_CODES >= 128)
_DIGIT = (_CODES >= 48) & (_CODES < 58)
_SPACE = (_CODES == 32) | (_CODES >= 9) & (_CODES < 14)
_STOP = np.isin(_CODES, [33, 44, 46, 58, 59, 63])
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _STOP)

NAMES = ["log_words", "word_length", "word_spread", "upper", "digits", "stops", "symbols", "symbol_words",
         "unlike_words", "top_word", "same_next", "top_pair", "line_words", "same_lines", "upper_words",
         "short_words"]


def _log_odds(part: float, whole: float) -> float:
    """A share as log-odds, with half a case on either side so that 0 and 1 stay finite."""
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics_of(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of ``NAMES``; all shares are log-odds."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    kinds = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    return [
        np.log1p(n),
        np.log1p(lengths.mean()) if n else 0.0,
        np.log1p(lengths.std()) if n else 0.0,
        _log_odds(int(counts[_UPPER].sum()), size),
        _log_odds(int(counts[_DIGIT].sum()), size),
        _log_odds(int(counts[_STOP].sum()), size),
        _log_odds(int(counts[_SYMBOL].sum()), size),
        _log_odds(sum(c for w, c in kinds.items() if not (w[-1].isalnum() or w[-1] in ".,;:?")), n),
        _log_odds(len(kinds), n),
        _log_odds(max(kinds.values(), default=0), n),
        _log_odds(sum(c for (a, b), c in pairs.items() if a == b), max(n - 1, 0)),
        _log_odds(max(pairs.values(), default=0), max(n - 1, 0)),
        np.log1p(n / max(len(lines), 1)),
        _log_odds(len(lines) - len(set(lines)), len(lines)),
        _log_odds(sum(c for w, c in kinds.items() if len(w) > 1 and w.isupper()), n),
        _log_odds(int((lengths < 3).sum()), n),
    ]


@dataclass
class Discriminant:
    """Two normal densities with their Cholesky factors inverted once, and a calibration."""

    means: np.ndarray
    roots: np.ndarray
    offsets: np.ndarray
    intercept: float = 0.0
    slope: float = 1.0

    @classmethod
    def of(cls, sizes: np.ndarray, sums: np.ndarray, squares: np.ndarray, shrink: float, ridge: float
           ) -> Discriminant:
        """From the rows, sums and sums of outer products of each class.

        Each covariance is drawn towards the pooled one by ``shrink`` and towards a multiple of
        the identity by ``ridge``.
        """
        d = sums.shape[1]
        means = sums / np.maximum(sizes, 1)[:, None]
        scatter = squares - sizes[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = scatter.sum(0) / max(sizes.sum() - 2, 1)
        roots, offsets = np.empty((2, d, d)), np.empty(2)
        for k in range(2):
            own = scatter[k] / max(sizes[k] - 1, 1)
            cov = (1 - shrink) * own + shrink * pooled
            cov = (1 - ridge) * cov + ridge * (np.trace(cov) / d + 1e-6) * np.eye(d)
            factor = np.linalg.cholesky((cov + cov.T) / 2)
            roots[k] = np.linalg.inv(factor)
            offsets[k] = np.log(sizes[k] + 0.5) - np.log(np.diag(factor)).sum()
        return cls(means, roots, offsets)

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0, with the class sizes as priors."""
        value = np.empty((2, len(x)))
        for k in range(2):
            z = (x - self.means[k]) @ self.roots[k].T
            value[k] = self.offsets[k] - 0.5 * np.einsum("ij,ij->i", z, z)
        return value[1] - value[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        v = self.intercept + self.slope * squashed(self.log_ratio(x))
        return 1 / (1 + np.exp(-np.clip(v, -700, 700)))


def squashed(ratio: np.ndarray) -> np.ndarray:
    """Log ratios on a scale that calibrates well: linear near 0, logarithmic far out."""
    return np.sign(ratio) * np.log1p(np.abs(ratio))


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics_of(t) for t in texts]).reshape(len(texts), len(NAMES))


def moment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) in; the sums that the fit needs out, one row per class and entry."""
    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        labels = np.array(batch.column(1).to_pylist(), int)
        x = _matrix(batch.column(0).to_pylist())
        for k in range(2):
            own = x[labels == k]
            total[k] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
    n = total.shape[1]
    yield pa.RecordBatch.from_arrays([
        pa.array(np.repeat([0, 1], n), pa.int32()), pa.array(np.tile(np.arange(n), 2), pa.int32()),
        pa.array(total.ravel())], ["_label", "_entry", "_value"])


def ratio_batches(batches: Iterator[pa.RecordBatch], model: Discriminant) -> Iterator[pa.RecordBatch]:
    """(text, label) in; (label, squashed log ratio in tenths) out."""
    for batch in batches:
        x = squashed(model.log_ratio(_matrix(batch.column(0).to_pylist())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(np.round(10 * x).astype(np.int64))], ["_label", "_ratio"])


def score_batches(batches: Iterator[pa.RecordBatch], model: Discriminant, place: int
                  ) -> Iterator[pa.RecordBatch]:
    """Add the score to each batch, from its text column at ``place``."""
    for batch in batches:
        x = np.array([statistics_of(v.as_py() or "") for v in batch.column(place)])
        scores = pa.array(model.score(x.reshape(batch.num_rows, len(NAMES))))
        yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "_score"])
