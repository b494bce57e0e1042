"""Words and five-word shingles as 64-bit hashes, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
WORD_ENTRIES = 400_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = tuple(np.uint64(s) for s in (30, 27, 31))
_FACTORS = tuple(np.uint64(f) for f in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> _SHIFTS[0])) * _FACTORS[0]
    x = (x ^ (x >> _SHIFTS[1])) * _FACTORS[1]
    return x ^ (x >> _SHIFTS[2])


# The low bits of a word's hash hold its number of letters and digits, up to 63.
LETTER_BITS = np.uint64(63)


class WordHashes(dict):
    """Blank-separated word -> hash of its letters and digits in lower case; 0 if it has none."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_ENTRIES:
            self.clear()
        import xxhash

        plain = word if word.isalnum() else "".join(filter(str.isalnum, word))
        value = (xxhash.xxh3_64_intdigest(plain) & ~63 | min(len(plain), 63)) if plain else 0
        self[word] = value
        return value

    def of(self, text: str) -> np.ndarray:
        words = text.lower().split()
        found = np.fromiter((self[w] for w in words), dtype=np.uint64, count=len(words))
        return found[found != 0]


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of `size` words; none if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = words[:n].copy()
    for j in range(1, size):
        total = total * _STEP + words[j : j + n]
    return mixed(total)


def shingle_letters(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Letters and digits in each run of `size` words."""
    sums = np.concatenate([[0], np.cumsum((words & LETTER_BITS).astype(np.int64))])
    return sums[size:] - sums[:-size] if len(words) >= size else sums[:0]
