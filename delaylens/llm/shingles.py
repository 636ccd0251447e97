"""Sets of hashed word shingles, for a slice of texts at once.

Words are runs of anything but the six ASCII blanks, A-Z lower-cased. Words get
codes by a dictionary of the slice and each distinct word one 64-bit hash (xxh3); a
shingle's hash mixes those of its words in order. Texts are cut at blanks into
parts of about ``PART`` bytes, so work arrays stay bounded however long a
text is. A text with fewer words than a shingle has one shingle, the whole
sequence; one without words has none.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

PART = 1 << 20
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F], np.uint64)
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LAST_BLANK = re.compile(rb"[\x20\x09-\x0D][^\x20\x09-\x0D]*\Z")
NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~IS_BLANK[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(stop - start)])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(LOWER[raw[inside]])])
    coded = words.dictionary_encode()
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return start, own[coded.indices.to_numpy()]


def _parts(data: bytes):
    """Cuts at blanks, about PART bytes apart."""
    while len(data) > PART:
        found = LAST_BLANK.search(data[PART - 4096:PART])
        cut = PART - 4096 + found.start() if found else (NEXT_BLANK.search(data, PART) or re.search(rb"\Z", data)).start()
        yield data[:cut]
        data = data[cut:]
    yield data


def shingle_sets(texts: list[str | None], words: int = 5) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes (uint64)."""
    coded = [(t or "").encode("utf-8") for t in texts]
    size = np.array([len(c) + 1 for c in coded], np.int64)
    first = np.cumsum(size) - size
    if size.sum() <= PART + (PART >> 2):
        start, h = _hash_words(b"\n".join(coded))
        stop = np.searchsorted(start, first + size)
    else:
        each = [[_hash_words(p)[1] for p in _parts(c)] for c in coded]
        h = np.concatenate([p for ps in each for p in ps])
        stop = np.cumsum([sum(map(len, ps)) for ps in each])
    begin = np.concatenate([[0], stop[:-1]]).astype(np.int64)
    n = len(h)
    rolled = np.zeros(max(0, n - words + 1), np.uint64)
    for j in range(words if len(rolled) else 0):
        rolled += h[j:n - words + 1 + j] * ODD[j]
    rolled = mix(rolled)
    out = []
    for a, b in zip(begin.tolist(), stop.tolist()):
        if b - a >= words:
            s = np.sort(rolled[a:b - words + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(mix((h[a:b] * ODD[:b - a]).sum(keepdims=True) + ODD[6:7] * np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_keys(sets: list[np.ndarray], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set, as signed integers."""
    size = np.array([len(s) for s in sets], np.int64)
    flat, stop = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.cumsum(size)
    keys = []
    for x in (mix(flat ^ ODD[1]), mix(flat + ODD[2])):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
        keys.append(sums[stop] - sums[stop - size])
    salt = mix(np.full(1, seed, np.uint64))
    return mix(keys[0] + size.astype(np.uint64) + salt).view(np.int64), mix(keys[1]).view(np.int64)
