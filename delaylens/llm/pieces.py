"""Cutting texts at spaces for the byte-level vocabularies' pattern.

The pattern ``'s|'t|... | ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
starts a new match at every space that follows a non-blank or precedes one, so
a text may be cut before such a space and the parts matched one by one. Only a
space amid blanks on both sides (or at the end after a blank) belongs to a run
that must stay whole; texts with such a run, or with a ``<|`` that may begin a
special string, count as one piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: fixed values: every character that some engine takes for a blank
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
UNSAFE = rf"{BLANK} ({BLANK}|$)|<\|"


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces, the index of each occurrence, and per text the end of
    its occurrences. Pieces joined in order give the texts back."""
    texts = texts.cast(pa.large_string())
    whole = pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(texts, " ")
    flat, counts = parts.flatten(), pc.list_value_length(parts).to_numpy().astype(np.int64)
    ends = np.cumsum(counts)
    first = np.zeros(len(flat), bool)
    first[(ends - counts)[counts > 0]] = True
    codes = pc.dictionary_encode(flat)
    index = codes.indices.to_numpy().astype(np.int64)
    n = len(codes.dictionary)
    # code 2k is word k after a space, 2k + 1 is word k at the start of a text
    index = 2 * index + first
    own = np.repeat(whole, counts)
    keep = ~own
    if whole.any():      # an unsafe text stands as one piece, in the place of its first part
        spot = (ends - counts)[whole]
        index[spot] = 2 * n + np.arange(len(spot))
        keep[spot] = True
    index = index[keep]
    seen = np.zeros(2 * n + int(whole.sum()), bool)
    seen[index] = True
    used = np.flatnonzero(seen[:2 * n])
    index = (np.cumsum(seen) - 1)[index]
    words = codes.dictionary.take(pa.array(used // 2)).to_pylist()
    pieces = [w if first else " " + w for w, first in zip(words, (used % 2).tolist())]
    if whole.any():
        pieces += texts.filter(pa.array(whole)).to_pylist()
    return pieces, index, np.cumsum(np.where(whole, 1, counts))


def gather(pool: np.ndarray, ends: np.ndarray, index: np.ndarray, run: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate variable-length entries: entry k is ``pool[ends[k-1]:ends[k]]``.
    Also returns the running end of each occurrence. Works in runs of
    occurrences, so the work arrays stay small beside the result."""
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ends) else ends
    size = (ends - starts)[index]
    stop = np.cumsum(size)
    out = np.empty(int(stop[-1]) if len(stop) else 0, pool.dtype)
    for a in range(0, len(index), run):
        n, upto = size[a:a + run], stop[a:a + run]
        begin = int(upto[0] - n[0])
        shift = starts[index[a:a + run]] - (upto - n)
        out[begin:int(upto[-1])] = pool[np.arange(begin, int(upto[-1])) + np.repeat(shift, n)]
    return out, stop


class Pool:
    """Variable-length entries by code, in one growing array."""

    def __init__(self, dtype):
        self.data, self.ends = np.zeros(0, dtype), np.zeros(0, np.int64)

    def add(self, data: np.ndarray, ends: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, ends + len(self.data)])
        self.data = np.concatenate([self.data, data])

    def take(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.data, self.ends, index)
