"""128-bit names of words and of sequences of words (``common.names``): of the whole text, unlike
:class:`common.Words`, which takes the first half and lower-cases."""

from __future__ import annotations

import numpy as np

from .common import KEYS, LOWER, mix, names, word_spans

U64 = np.uint64


class StrongWords:
    """Words of a block of rows: spans in bytes, first word of each row, and both halves of their names."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray, lower: bool, halves: int = 2):
        data = LOWER[buf] if lower else np.ascontiguousarray(buf)
        self.start, self.end, self.first = word_spans(data, offs, is_word)
        self.names = names(data, self.start, self.end, halves)


def spans_names(words: list[np.ndarray], start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The halves of the names of word sequences: start and number of words of each."""
    if not len(start):
        return [np.empty(0, U64) for _ in words]
    head = np.cumsum(size) - size
    place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(head, size)
    at = np.repeat(start, size) + place
    place = place.astype(U64)
    out = []
    for h, keys in zip(words, KEYS):
        out.append(mix(np.add.reduceat(mix(h[at] ^ place * keys[0] + keys[1]), head) + size.astype(U64) * keys[1]))
    return out
