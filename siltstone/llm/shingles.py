"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(29)


def word_hashes(text: str) -> np.ndarray:
    """A hash per word: runs of other bytes than ASCII white space, with A-Z in lower case."""
    return hashed(text.encode("utf-8", "replace").lower().split())


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words, in text order; fewer words are one run, none have none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    found = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        found = (found ^ words[j : j + n]) * _ODD
        found ^= found >> _SHIFT
    return found * _ODD2


def shingle_set(text: str, size: int) -> np.ndarray:
    """The sorted distinct shingles of a text."""
    return np.unique(shingle_hashes(word_hashes(text), size))
