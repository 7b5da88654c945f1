"""Signature trees over token bitmaps: which pairs of sets can be similar enough.

A leaf is one set: its size and a bitmap with the bit ``hash mod width`` of each
of its tokens. An inner node holds the OR of its children's bitmaps, the range of
their sizes, and the most tokens that any of its sets loses to shared bits. Two
trees (or one with itself) are walked together from the roots; a pair of nodes is
dropped when no pair of sets below it can reach the needed overlap.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
#: Bytes of bitmaps that are compared in one step.
STEP_BYTES = 4 << 20


def bitmap(tokens: np.ndarray, per_token: int = 2) -> bytes:
    """Bitmap of a set of token hashes: ``per_token`` to twice as many bits for each,
    from 256 bits to 32 KiB."""
    log = min(18, max(8, int(np.ceil(np.log2(max(1, per_token * len(tokens)))))))
    bits = np.zeros(1 << log, np.uint8)
    bits[(tokens & np.uint64((1 << log) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(words: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of ``width`` words: bit positions modulo the new width."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] | words[:, half:]
    return words


def _count(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(1, dtype=np.int64)


class SignatureTree:
    """``levels[0]`` are the sets in order of size, the last level is the root."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, rows: np.ndarray):
        order = np.lexsort((words[:, 0], sizes))
        self.rows = rows[order]
        bits, low = words[order], sizes[order].astype(np.int64)
        lost = low - _count(bits)
        self.levels = [(bits, low, low, lost)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, lost = self.levels[-1]
            cut = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, cut, axis=0),
                                np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                                np.maximum.reduceat(lost, cut)))


def _possible(a, b, i: np.ndarray, j: np.ndarray, leaf: bool, num: int, den: int) -> np.ndarray:
    """Whether nodes a[i] and b[j] may hold sets x, y with den * |x & y| >= num * |x | y|."""
    ok = (den * a[2][i] >= num * b[1][j]) & (den * b[2][j] >= num * a[1][i])
    step = max(1, STEP_BYTES // (8 * a[0].shape[1]))
    for s in range(0, len(i), step):
        at = s + np.flatnonzero(ok[s:s + step])
        if not len(at):
            continue
        x, y = a[0][i[at]], b[0][j[at]]
        if leaf:  # a bit of one side alone stands for at least one token of it alone
            most = np.minimum(a[1][i[at]] - _count(x & ~y),
                              b[1][j[at]] - _count(y & ~x))
        else:
            most = np.minimum(np.minimum(a[3][i[at]], b[3][j[at]])
                              + _count(x & y),
                              np.minimum(a[2][i[at]], b[2][j[at]]))
        ok[at] = (num + den) * most >= num * (a[1][i[at]] + b[1][j[at]])
    return ok


def dual_walk(a: SignatureTree, b: SignatureTree, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (from a, from b) that the bounds leave; a is b: each pair once."""
    same = a is b
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    i = j = np.zeros(0 if same and la == 0 else 1, np.int64)
    while True:
        ok = _possible(a.levels[la], b.levels[lb], i, j, la == lb == 0, num, den)
        i, j = i[ok], j[ok]
        if not len(i) or la == lb == 0:
            return a.rows[i], b.rows[j]
        down_a, down_b = la >= lb, lb >= la
        if down_a:
            la -= 1
            i, j = _children(i, j, len(a.levels[la][0]))
        if down_b:
            lb -= 1
            j, i = _children(j, i, len(b.levels[lb][0]))
        if same:
            keep = i < j if la == 0 else i <= j
            i, j = i[keep], j[keep]


def _children(node: np.ndarray, other: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The children (of ``n`` in all) of each node, each with the node's partner."""
    kids = node[:, None] * FANOUT + np.arange(FANOUT)
    ok = kids < n
    return kids[ok], np.repeat(other, ok.sum(1))


def possible_pairs(sizes: np.ndarray, bitmaps: list[bytes], num: int, den: int,
                   left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets whose Jaccard similarity may be num / den or more.

    With ``left`` (boolean), only pairs of one set in it and one outside. Sets
    with bitmaps of one width share a tree; between trees the wider bitmaps are
    folded to the narrower width.
    """
    width = np.fromiter((len(x) // 8 for x in bitmaps), np.int64, len(bitmaps))
    left = np.zeros(len(bitmaps), bool) if left is None else left
    two = bool(left.any())
    groups = []
    for w in np.unique(width):
        for side in (True, False) if two else (False,):
            rows = np.flatnonzero((width == w) & (left == side))
            if len(rows):
                words = np.frombuffer(b"".join(bitmaps[r] for r in rows), np.uint64)
                groups.append((int(w), side, rows, words.reshape(len(rows), int(w))))
    found_i, found_j = [], []
    trees: dict[tuple[int, int], SignatureTree] = {}

    def tree(k: int, w: int) -> SignatureTree:
        if (k, w) not in trees:
            _, _, rows, words = groups[k]
            trees[k, w] = SignatureTree(sizes[rows], _fold(words, w), rows)
        return trees[k, w]

    for x in range(len(groups)):
        for y in range(x, len(groups)):
            if two and groups[x][1] == groups[y][1]:
                continue
            w = min(groups[x][0], groups[y][0])
            i, j = dual_walk(tree(x, w), tree(y, w), num, den)
            found_i.append(i)
            found_j.append(j)
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def spanning_pairs(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs, a spanning forest: as few as connect what all of them connect."""
    linked = np.zeros((n, n), bool)
    linked[i, j] = linked[j, i] = True
    seen = np.zeros(n, bool)
    out_i, out_j = [], []
    for root in np.unique(np.concatenate([i, j])).tolist() if len(i) else []:
        if seen[root]:
            continue
        seen[root] = True
        front = np.array([root])
        while len(front):
            reach = linked[front]
            fresh = np.flatnonzero(reach.any(0) & ~seen)
            out_i.append(front[reach[:, fresh].argmax(0)])
            out_j.append(fresh)
            seen[fresh] = True
            front = fresh
    if not out_i:
        return i[:0], j[:0]
    return np.concatenate(out_i), np.concatenate(out_j)


def small_block_pairs(starts: np.ndarray, lens: np.ndarray, sizes: np.ndarray,
                      bitmaps: list[bytes], wanted, num: int,
                      den: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs left by the leaf bounds in blocks of rows (start, length), all at once.

    ``wanted(i, j)`` says which pairs of rows count.
    """
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(lens[lens > 1]).tolist():
        x, y = np.triu_indices(n, 1)
        at = starts[lens == n][:, None]
        found_i.append((at + x).ravel())
        found_j.append((at + y).ravel())
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    ok = (den * sizes[i] >= num * sizes[j]) & (den * sizes[j] >= num * sizes[i]) & wanted(i, j)
    i, j = i[ok], j[ok]
    width = np.fromiter((len(x) // 8 for x in bitmaps), np.int64, len(bitmaps))
    w = np.minimum(width[i], width[j])
    keep = np.zeros(len(i), bool)
    for one in np.unique(w).tolist():
        at = np.flatnonzero(w == one)
        rows, back = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        words = np.zeros((len(rows), one), np.uint64)
        for own in np.unique(width[rows]).tolist():
            some = np.flatnonzero(width[rows] == own)
            raw = np.frombuffer(b"".join(bitmaps[r] for r in rows[some]), np.uint64)
            words[some] = _fold(raw.reshape(len(some), own), one)
        size = sizes[rows].astype(np.int64)
        leaves = (words, size, size, size)
        keep[at] = _possible(leaves, leaves, back[:len(at)], back[len(at):], True, num, den)
    return i[keep], j[keep]
