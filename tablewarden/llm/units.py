"""Token ids of many texts by the tokenizers library, each distinct piece of text encoded once.

Between two characters that are not white space a single blank always starts a new word of a
byte-level tokenizer, so a text cut at such blanks can be encoded piece by piece. Pieces repeat:
Arrow numbers the distinct ones of many texts, Python sees each of those once, and a task remembers
them. What a piece is made of is cut further by the tokenizer's own word pattern, where the
characters leave no doubt about it; other pieces go to the library whole.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import regex

# Pieces and words that a task remembers: two generations of so many each.
PIECES, WORDS = 300_000, 400_000
# The word pattern of byte-level tokenizers (fixed value).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose classes all libraries agree on.
_PLAIN = re.compile("[\n\x20-\x7e\xa1-ɏ]*").fullmatch
# One word of letters, then one of marks or none: what most pieces are.
_SIMPLE = re.compile("([A-Za-zªµºÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@[-`{-~]*)").fullmatch
_LONE_BLANK = re.compile(r"(?<!\s) (?!\s)")
# Characters that the library encodes at a time; its result takes many times their length.
_WHOLE_CHARS = 1_000_000


def portions(texts: Iterable[str], chars: int) -> Iterator[list[str]]:
    """Texts in order, a portion ending with the one that brings it to ``chars`` characters."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


class _Remembered:
    """A dictionary of bounded size that forgets what was not used lately."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def values(self, keys: list[str], learn: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The values of the keys; ``learn`` gives those that are not known."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        values = list(map(self.new.get, keys))
        gaps = [i for i, v in enumerate(values) if v is None]
        asked = [keys[i] for i in gaps]
        found = list(map(self.old.get, asked))
        new = self.new
        new.update((k, v) for k, v in zip(asked, found, strict=True) if v is not None)
        unknown = list(dict.fromkeys([k for k, v in zip(asked, found, strict=True) if v is None]))
        learned = dict(zip(unknown, learn(unknown), strict=True))
        new.update(learned)
        for i, key, value in zip(gaps, asked, found, strict=True):
            values[i] = learned[key] if value is None else value
        return values


class Encoder:
    """Ids as little-endian 32-bit integers, equal to those of the library for the whole text."""

    def __init__(self, data: str):
        # Spark runs one task a core, so the library stays within one.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = Tokenizer.from_str(data)
        kind = self.library.pre_tokenizer
        self.plain = (isinstance(kind, pre_tokenizers.ByteLevel) and not kind.add_prefix_space
                      and self.library.normalizer is None
                      and getattr(kind, "use_regex", True))
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words, self.pieces, self.firsts = (_Remembered(WORDS), _Remembered(PIECES), _Remembered(PIECES))
        self.find = regex.compile(WORD).findall
        # What the library writes for the bytes of a plain character.
        alone = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.written = {i: alone(chr(i))[0][0] for i in range(0x250) if _PLAIN(chr(i))}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for part in portions(texts, _WHOLE_CHARS)
                for e in self.library.encode_batch_fast(part, add_special_tokens=False)]

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Words of plain characters go to the library's model at once; they need no cutting."""
        tokenize, made = self.model.tokenize, []
        for part in portions(words, _WHOLE_CHARS):
            ids, ends = [], [0]
            # A tabulator is not a plain character.
            for written in "\t".join(part).translate(self.written).split("\t"):
                ids += [t.id for t in tokenize(written)]
                ends.append(len(ids))
            packed = np.array(ids, "<u4").tobytes()
            made += [packed[4 * i:4 * j] for i, j in itertools.pairwise(ends)]
        return made

    def _of_pieces(self, pieces: list[str], before: str) -> list[bytes]:
        """The ids of ``before`` + piece for the pieces."""
        words, counts, whole = [], [], []
        for piece in pieces:
            if simple := _SIMPLE(piece):
                letters, marks = simple.groups()
                words.append(before + letters)
                if marks:
                    words.append(marks)
                counts.append(2 if marks else 1)
            elif _PLAIN(piece):
                found = self.find(before + piece)
                words += found
                counts.append(len(found))
            else:
                whole.append(before + piece)
                counts.append(-1)
        ids, others = iter(self.words.values(words, self._of_words)), iter(self._whole(whole))
        return [next(ids) if n == 1 else next(others) if n < 0 else b"".join(itertools.islice(ids, n)) for n in counts]

    def _joined(self, coded: pa.DictionaryArray, ends: np.ndarray) -> list[bytes]:
        """The ids of texts that are given as all their pieces and the places between texts."""
        codes, starts = np.array(coded.indices, np.int64), ends[:-1]
        # No blank comes before the first piece of a text.
        firsts = coded.dictionary.take(pa.array(codes[starts])).to_pylist()
        codes[starts] = -1
        used = np.zeros(len(coded.dictionary) + 1, bool)
        used[codes] = True
        # numpy makes the strings many times as fast as to_pylist.
        rest = coded.dictionary.filter(pa.array(used[:-1])).to_numpy(zero_copy_only=False).tolist()
        codes = (np.cumsum(used) - 1)[codes]
        codes[starts] = len(rest) + np.arange(len(firsts))
        known = self.pieces.values(rest, partial(self._of_pieces, before=" "))
        known += self.firsts.values(firsts, partial(self._of_pieces, before=""))
        _, places, data = pa.array(known, pa.large_binary()).take(pa.array(codes)).buffers()
        at = np.frombuffer(places, np.int64)[ends].tolist()
        packed = memoryview(data or b"")
        return [bytes(packed[i:j]) for i, j in itertools.pairwise(at)]

    def _loose(self, texts: list[str]) -> list[bytes]:
        cut = pa.array([_LONE_BLANK.split(t) for t in texts], pa.list_(pa.large_string()))
        return self._joined(cut.values.dictionary_encode(), np.asarray(cut.offsets))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.plain or not texts:
            return self._whole(texts)
        # The library finds special tokens before it finds words.
        odd = [any(s in t for s in self.special) for t in texts]
        if any(odd):
            return _dealt(texts, odd, self._whole, self.encode)
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded, ends = cut.values.dictionary_encode(), np.asarray(cut.offsets)
        # Blanks next to other white space stay inside a piece.
        pieces = coded.dictionary
        loose = np.array(pc.or_(pc.equal(pieces, ""), pc.not_equal(pc.utf8_trim_whitespace(pieces), pieces)))
        if loose.any():
            found = np.logical_or.reduceat(loose[np.asarray(coded.indices)], ends[:-1])
            return _dealt(texts, found.tolist(), self._loose, self.encode)
        return self._joined(coded, ends)


def _dealt(texts: list[str], odd: list[bool], one: Callable[[list[str]], list[bytes]],
           other: Callable[[list[str]], list[bytes]]) -> list[bytes]:
    """``one`` of the odd texts and ``other`` of the rest, in the order of the texts."""
    ones = iter(one([t for t, o in zip(texts, odd, strict=True) if o]))
    others = iter(other([t for t, o in zip(texts, odd, strict=True) if not o]))
    return [next(ones if o else others) for o in odd]


def read_text(path: str) -> str:
    files, inner = pyarrow.fs.FileSystem.from_uri(path)
    with files.open_input_stream(inner) as stream:
        return stream.read().decode()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of the tokenizer file at ``path``, read once per worker process."""
    return Encoder(read_text(path))
