"""Hashes of words and of runs of words, for whole texts of any length."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

SEED = 42
# Bytes of a text that are split into words at once.
SLICE_BYTES = 4 << 20
_SPACE = re.compile(rb"[ \t-\r]")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


class WordHashes(dict):
    """64-bit hashes by word. Frequent words are hashed once; when there are too many, it starts again."""

    def __init__(self, most: int = 1 << 18):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


SEEN = WordHashes()


def slices(text: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """The text in slices of about a size, cut where a word has ended."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + size)
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word; A-Z count as a-z, and words end at white space."""
    parts = []
    for piece in slices(text):
        words = piece.lower().split()
        parts.append(np.fromiter(map(SEEN.__getitem__, words), dtype=np.uint64, count=len(words)))
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def shingles(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's runs of words; of all words if there are no more, none without."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    runs = len(hashes) - width + 1
    mixed = np.full(runs, width, dtype=np.uint64)
    for i in range(width):
        mixed ^= hashes[i : runs + i]
        mixed *= _MULTIPLIER
        mixed ^= mixed >> _SHIFT
    return np.unique(mixed)
