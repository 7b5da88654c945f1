"""Words, 64-bit word hashes and word n-grams of a slice of texts, in numpy.

Words are runs of bytes outside x20 and x09-x0D, which on UTF-8 is the pattern
``[^\\x20\\x09-\\x0D]+``. A word's hash is a polynomial over a random value per
byte, finalised by a bijective mixer; an n-gram's hash mixes its words in order.
"""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(
    1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Word spans of a slice: ``start``, ``end``, ``doc`` (all per word)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        n = len(data)
        word = ~_BLANK[data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            before[offs[:-1][offs[:-1] < n]] = False
            after[offs[1:][offs[1:] > 0] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.doc = np.searchsorted(offs, self.start, side="right") - 1
        self._word = word

    def per_doc(self) -> np.ndarray:
        """First word of each document, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(len(self.offs)))

    def hashes(self, lower: bool = False) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lens = self.end - self.start
        first = np.cumsum(lens) - lens
        inside = np.arange(int(lens.sum())) - np.repeat(first, lens)
        terms = (_BYTE_LOWER if lower else _BYTE)[self.data[self._word]]
        terms *= _powers(int(lens.max()))[inside]
        return mix64(np.add.reduceat(terms, first) + lens.astype(np.uint64))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (over document borders too)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - n + 1, np.uint64(n), np.uint64)
    for k in range(n):
        out = mix64(out * _BASE + words[k:len(words) - n + 1 + k])
    return out


def shingle_sets(words: Words, n: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes per document.

    A document with fewer than ``n`` words has its whole sequence as its one
    n-gram; one without words has none.
    """
    h = words.hashes(lower)
    grams = ngram_hashes(h, n)
    bounds = words.per_doc()
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(ngram_hashes(h[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
