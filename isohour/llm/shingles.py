"""Word shingles of whole texts as sorted 64-bit hashes, worked out in numpy batch by batch."""

from __future__ import annotations

import numpy as np
import xxhash

from isohour.llm.common import kept

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
REMEMBERED_BYTES = 80 << 20  # what a worker keeps, at ENTRY bytes a word and its own
ENTRY = 160


class WordHashes(dict):
    held = 0

    def __missing__(self, word: bytes) -> int:
        self.held += len(word) + ENTRY
        if self.held > REMEMBERED_BYTES:
            self.clear()
            self.held = len(word) + ENTRY
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = 2) -> np.ndarray:
    """The distinct shingles of ``width`` words; the whole sequence as one if there are fewer words.

    A-Z count as a-z; words are runs of anything but space and the control characters tab to return.
    """
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(kept("word hashes", WordHashes).__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - n + 1 + k])
    return np.unique(total)
