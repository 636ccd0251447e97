"""Counting the phrases of a slice of texts, exactly.

Texts are UTF-8 bytes. A-Z count as a-z; ``.,;:!?`` and line ends break a text
into pieces, spaces and tabs a piece into words. Words get codes by a dictionary
of the slice, a phrase of up to three words is one integer of its words' codes, and
equal integers are counted by sorting. Texts over ``PART`` bytes are cut behind a
word; a part sees the next two words but counts only phrases that begin in itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from delaylens.llm.shingles import ODD, mix

PART = 4 << 20
LONGEST = 3
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = 1
CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
GAP = re.compile(rb"[\x20\x09-\x0D.,;:!?]")
WORDS_AHEAD = re.compile(rb"(?:[\x20\x09-\x0D.,;:!?]*[^\x20\x09-\x0D.,;:!?]+){0,%d}" % (LONGEST - 1))


def parts(data: bytes) -> Iterator[tuple[bytes, int]]:
    """Cuts of a text: bytes with the words ahead, and how many bytes are the part's own."""
    at = 0
    while len(data) - at > PART:
        gap = GAP.search(data, at + PART)
        cut = gap.end() if gap else len(data)
        yield data[at:WORDS_AHEAD.match(data, cut).end()], cut - at
        at = cut
    yield data[at:], len(data) - at


class Counted:
    """The words of a slice in order, and its distinct phrases length by length."""

    def __init__(self, data: bytes, own: int):
        raw = np.frombuffer(data, np.uint8)
        kind = CLASS[raw]
        inside = kind == 0
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(stop - start)])
        words = pa.Array.from_buffers(pa.large_utf8(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(LOWER[raw[inside]])])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.bits = max(1, len(self.words).bit_length())
        if self.bits * LONGEST > 63:
            raise ValueError("too many distinct words in a slice")
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        self.n_words = int(np.searchsorted(start, own))
        self.named: np.ndarray | None = None

    def level(self, k: int, alive: np.ndarray | None = None) -> Level:
        """Phrases of k words; ``alive`` tells where phrases of one word less may begin."""
        n = max(0, len(self.code) - k + 1)
        key = self.code[:n] + 1
        for j in range(1, k):
            key = (key << self.bits) | (self.code[j:n + j] + 1)
        fits = self.piece[:n] == self.piece[k - 1:n + k - 1]
        if alive is not None:
            fits &= alive[:n] & alive[1:n + 1]
        return Level(k, np.flatnonzero(fits), key[fits], self.n_words)

    def alive(self, level: Level, member: np.ndarray) -> np.ndarray:
        """By place: a phrase that is a member begins there."""
        out = np.zeros(len(self.code) + 1, bool)
        out[level.at[member[np.searchsorted(level.distinct, level.key)]]] = True
        return out

    def codes(self, k: int, key: np.ndarray) -> list[np.ndarray]:
        """Codes of the words of k-word phrases, in order."""
        return [((key >> (self.bits * (k - 1 - j))) & ((1 << self.bits) - 1)) - 1 for j in range(k)]

    def hashes(self, salt: str, level: Level) -> np.ndarray:
        """A 64-bit hash of every distinct phrase of the level."""
        if self.named is None:
            self.named = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()], np.uint64)
        base = np.array([xxhash.xxh3_64_intdigest(salt)], np.uint64)
        h = np.repeat(base + ODD[6:7] * np.uint64(level.k), len(level.distinct))
        for j, code in enumerate(self.codes(level.k, level.distinct)):
            h += self.named[code] * ODD[j]
        return mix(h).view(np.int64)

    def texts(self, level: Level, which: np.ndarray) -> pa.Array:
        """The phrases themselves, words joined by a space."""
        words = [self.words.take(pa.array(c)) for c in self.codes(level.k, level.distinct[which])]
        return words[0] if level.k == 1 else pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_utf8()))


class Level:
    """Phrases of k words: their places and keys, the distinct keys in order and how often each begins in the slice's own words."""

    def __init__(self, k: int, at: np.ndarray, key: np.ndarray, own: int):
        self.k, self.at, self.key = k, at, key
        in_order = np.sort(key)
        first = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.distinct = in_order[first]
        self.counts = np.diff(first, append=len(key))
        np.subtract.at(self.counts, np.searchsorted(self.distinct, key[at >= own]), 1)


class Slices:
    """Texts gathered by language until a slice is full."""

    def __init__(self):
        self.held, self.size, self.total = {}, {}, 0

    def _count(self, lang: str) -> Counted:
        data = b"\n".join(self.held.pop(lang))
        self.total -= self.size.pop(lang)
        return Counted(data, len(data))

    def add(self, langs: list[str], texts: pa.Array) -> Iterator[tuple[str, Counted]]:
        for lang, text in zip(langs, texts):
            data = text.as_buffer().to_pybytes()
            if len(data) > PART:
                for part, own in parts(data):
                    yield lang, Counted(part, own)
                continue
            self.held.setdefault(lang, []).append(data)
            self.size[lang] = self.size.get(lang, 0) + len(data) + 1
            self.total += len(data) + 1
            if self.size[lang] > PART:
                yield lang, self._count(lang)
            elif self.total > 4 * PART:
                yield from self.rest()

    def rest(self) -> Iterator[tuple[str, Counted]]:
        for lang in list(self.held):
            yield lang, self._count(lang)
