"""Cut texts into units that byte-level BPE encodes independently.

A text is cut only where the public split pattern always ends one pre-token and starts the
next, whatever stands farther off, and where the cut leaves no blanks at a unit's end that
the pattern would read otherwise there:

* before a single space between two non-blanks,
* after a letter that a byte of ASCII other than a letter or a space follows,
* after a single line feed between two non-blanks.

Other blanks (double spaces, tabs, blanks beyond ASCII) stay inside a unit. Units repeat
often, so each distinct one is encoded once per slice and kept in a bounded cache of Arrow
and numpy arrays, and token sequences are gathered with numpy.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .arrowtext import utf8

#: Bytes of a unit that is kept, and places whose ids are gathered at once.
KEPT_BYTES = 64
GATHERED = 1 << 19

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)  # ASCII but letters and space
_MARK[:128] = ~_LETTER[:128]
_MARK[32] = False
_SOLID = np.zeros(256, bool)  # ASCII that is no blank and no control character
_SOLID[33:127] = True


def _blank_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a blank beyond ASCII may begin at the places ``at`` (of its first byte)."""
    n = len(data)
    a, b = data[at], data[np.minimum(at + 1, n - 1)]
    c = data[np.minimum(at + 2, n - 1)]
    return (((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
            | ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE3) & (b == 0x80))
            | ((a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
                              | (b == 0x81) & (c == 0x9F))))


def _cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places in ``data``, ascending, where a unit begins (the texts' first bytes too)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    letter, solid = _LETTER[data], _SOLID[data]
    wide = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)) + 1
    letter[wide] = True  # the last byte of U+00C0 to U+00FF, without the two that are signs
    begins = np.zeros(n, bool)
    begins[1:] = letter[:-1] & _MARK[data[1:]]
    line = (data[1:-1] == 10) & (solid[:-2] | letter[:-2]) & solid[2:]
    begins[2:] |= line
    space = np.flatnonzero(data == 32)
    space = space[(space > 0) & (space < n - 1)]
    left, right = data[space - 1], data[space + 1]
    ok = (_SOLID[left] | (left >= 128)) & (_SOLID[right] | (right >= 128))
    odd = np.flatnonzero(ok & (right >= 128))
    ok[odd] &= ~_blank_at(data, space[odd] + 1)
    for size in (2, 3):  # bytes of a blank that may end before the space
        odd = np.flatnonzero(ok & (left >= 128) & (space >= size))
        ok[odd] &= ~_blank_at(data, space[odd] - size)
    begins[space[ok]] = True
    # What is read across the end of a text says nothing: a space or a line feed that ends a
    # text, or a second byte that begins one, is no cut.
    first = offs[:-1][np.diff(offs) > 0]
    last = offs[1:][np.diff(offs) > 0] - 1
    begins[last[data[last] == 32]] = False
    second = first[1:] + 1 if len(first) > 1 else first[:0]
    second = second[second < n]
    second = second[data[second - 1] == 10]
    begins[second] = False
    begins[first] = True
    return np.flatnonzero(begins)


class Units:
    """``texts``: distinct units (large_string); ``seq``: a unit number per place; ``bounds``:
    first place of each document, and the number of places at the end."""

    def __init__(self, texts: pa.Array):
        data, offs = utf8(texts)
        begins = _cuts(data, offs)
        self.bounds = np.searchsorted(begins, offs)
        places = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(np.append(begins, len(data)).astype(np.int64)),
            pa.py_buffer(data))
        coded = places.dictionary_encode()
        self.texts = coded.dictionary
        self.seq = np.asarray(coded.indices)


class _Known:
    """Distinct units with their ids end to end."""

    def __init__(self, units: pa.Array | None = None, ids: np.ndarray | None = None,
                 sizes: np.ndarray | None = None):
        self.units = pa.array([], pa.large_string()) if units is None else units
        self.ids = np.zeros(0, np.uint32) if ids is None else ids
        self.sizes = np.zeros(0, np.int32) if sizes is None else sizes

    def find(self, units: pa.Array) -> np.ndarray:
        """Number of each of ``units``, or -1."""
        if not len(self.units):
            return np.full(len(units), -1)
        return np.asarray(pc.index_in(units, self.units).fill_null(-1))

    def take(self, at: np.ndarray) -> _Known:
        starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        return _Known(self.units.take(pa.array(at)), gather(self.ids, starts, self.sizes, at)[0],
                      self.sizes[at])

    def and_those(self, other: _Known) -> _Known:
        return _Known(pa.concat_arrays([self.units, other.units]),
                      np.concatenate([self.ids, other.ids]), np.concatenate([self.sizes, other.sizes]))


class UnitCache:
    """Ids per unit text, in two generations.

    A unit found in the old generation moves to the young one; when the young one
    has half of ``size`` entries it becomes the old one. So frequent units stay
    and memory is bounded. All of a slice's units are looked up at once by Arrow.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], size: int):
        """``encode`` gives the ids of units as little-endian 32-bit integers."""
        self.encode, self.half = encode, size // 2
        self.young, self.old = _Known(), _Known()

    def __call__(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each of the distinct ``units`` start, and how many."""
        young, old = self.young, self.old
        at = self.young.find(units)
        rest = np.flatnonzero(at < 0)
        left = units.take(pa.array(rest))
        in_old = old.find(left)
        new = left.take(pa.array(np.flatnonzero(in_old < 0)))
        found = self.encode(new.to_pylist())
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        made = _Known(new, np.frombuffer(b"".join(found), "<u4"), sizes)
        del found
        number = np.asarray(at, np.int64).copy()  # of each unit among the three in turn
        number[rest] = np.where(in_old >= 0, len(young.units) + in_old, 0)
        number[rest[in_old < 0]] = len(young.units) + len(old.units) + np.arange(len(new))
        ids = np.concatenate([young.ids, old.ids, made.ids])
        size = np.concatenate([young.sizes, old.sizes, made.sizes]).astype(np.int64)
        start = np.cumsum(size) - size
        short = np.flatnonzero(np.asarray(pc.binary_length(new)) <= KEPT_BYTES)
        self._keep(old.take(in_old[in_old >= 0]).and_those(made.take(short)))
        return ids, start[number], size[number]

    def _keep(self, more: _Known) -> None:
        if len(more.units) > self.half:
            more = more.take(np.arange(self.half))
        if len(self.young.units) + len(more.units) > self.half:
            self.old, self.young = self.young, more
        else:
            self.young = self.young.and_those(more)


def gather(ids: np.ndarray, start: np.ndarray, size: np.ndarray,
           seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the units named by ``seq`` end to end, and the number at each place."""
    at = size[seq].astype(np.int64)
    flat = np.empty(int(at.sum()), ids.dtype)
    done = 0
    for k in range(0, len(seq), GATHERED):
        some = at[k:k + GATHERED]
        ends = np.cumsum(some)
        n = int(ends[-1])
        index = np.arange(n) + np.repeat(start[seq[k:k + GATHERED]] - (ends - some), some)
        np.take(ids, index, out=flat[done:done + n], mode="clip")
        done += n
    return flat, at
