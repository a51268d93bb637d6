"""Words and word n-grams as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, in lower case (A-Z)."""
    return text.encode().lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place on; of all words where there are fewer."""
    n = min(n, len(hashes))
    if not n:
        return np.empty(0, np.uint64)
    out = np.full(len(hashes) - n + 1, 0x9E3779B97F4A7C15, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ hashes[k : k + len(out)]) * np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(29)
    return out
