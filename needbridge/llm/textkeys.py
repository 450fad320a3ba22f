"""64-bit keys of words and word shingles, computed in Arrow batches with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hash a worker keeps; the table is emptied beyond it (it is only a cache).
CACHED_WORDS = 100_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
EMPTY = np.zeros(0, np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Keys of all runs of ``width`` words, in text order (none if there are fewer words)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return EMPTY
    key = hashes[:n]
    for j in range(1, width):
        key = mix(key * _MUL + hashes[j:j + n])
    return mix(key + np.uint64(width))


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle keys; a shorter text is one shingle of all its words."""
    if len(hashes) == 0:
        return EMPTY
    return np.unique(windows(hashes, min(width, len(hashes))))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
