"""Words and word shingles as 64-bit hashes, in numpy."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ in UTF-8, with A-Z lower-cased on demand."""
    data = (text or "").encode()
    return (data.lower() if lower else data).split()  # bytes know only these six white space characters


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    digests = map(xxhash.xxh64_intdigest, words, repeat(seed)) if seed else map(xxhash.xxh64_intdigest, words)
    return np.fromiter(digests, np.uint64, len(words))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for every n consecutive words; empty for fewer words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out *= MULTIPLIER
        out += hashes[k : k + count]
    return mixed(out)


def shingle_set(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; fewer words are one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(rolling(word_hashes(words), min(n, len(words))))
