"""Word shingles as 64-bit hashes, vectorised over the words of a text."""

from __future__ import annotations

import numpy as np
import xxhash

from . import common
from .suffix_dedup import _mix

CACHE = 300_000


class WordHashes(dict):
    """Word to 64-bit hash; kept in a bounded cache."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= CACHE:
            self.clear()
        self[word] = h
        return h


def kept_words() -> WordHashes:
    """The cache that this Python worker keeps across tasks."""
    return common.kept("words", None, WordHashes)


def word_hashes(words: list[str], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def of(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words, repeats included. A text of fewer words is one shingle,
    an empty one has none."""
    if not len(hashes):
        return hashes
    n = max(len(hashes) - size + 1, 1)
    out = np.full(n, min(len(hashes), size), dtype=np.uint64)
    for i in range(min(size, len(hashes))):
        out = _mix(out + hashes[i : i + n])
    return out
