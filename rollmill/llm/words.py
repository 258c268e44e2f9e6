"""Words of texts and their hashes, for the operators that work on words in Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

MASK = (1 << 64) - 1


def words_of(text: str) -> list[bytes]:
    """Maximal runs of characters other than space, tab and the line breaks U+000A to U+000D, with
    A-Z in lower case. Both hold for UTF-8 bytes as well, where Python's own splitting does it."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``width`` words; of the whole if there are fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    span = min(n, width)
    factors = odd_numbers(width, seed=span)  # a short text is no shingle of a longer one
    total = np.zeros(n - span + 1, dtype=np.uint64)
    for k in range(span):
        total += mix(hashes[k : n - span + 1 + k] + factors[k]) * factors[k]
    return np.unique(mix(total))
