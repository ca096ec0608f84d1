"""Hashed word shingles of texts."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def odd_numbers(count: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed)) | np.uint64(1)


_PLACES = odd_numbers(WORDS, 1)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z in lower case."""
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def sequence_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order."""
    places = _PLACES if size == WORDS else odd_numbers(size, 1)
    n = len(words) - size + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(size if n > 0 else 0):
        total += words[i : i + n] * places[i]
    return mixed(total)


def shingle_set(text: bytes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; of fewer words, the whole
    sequence is one; without words there are none."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < size:
        short = np.sum(words * odd_numbers(len(words), 1), dtype=np.uint64, keepdims=True)
        return mixed(short + _GOLDEN * np.full(1, len(words), dtype=np.uint64))
    return np.unique(sequence_hashes(words, size))
