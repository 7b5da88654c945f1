"""Byte-level BPE encoding and decoding from a file of merge ranks.

Per pre-token, all vocabulary entries that occur in it are found by one
Aho-Corasick pass (bytes are mapped to Latin-1 characters for the automaton).
Encoding then walks from left to right with the longest entry at each place and
steps back to the next shorter one whenever the last two tokens could not have
stood side by side after the merges. Whether two tokens may be neighbours is
decided by undoing their merges from the joint outwards, and is memoised. Each
(place, token) is tried at most once, so the time is linear in the text.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrowtext import kept, text_slices, utf8
from .pretokens import UnitCache, Units, gather

#: Entries of the neighbour memo and of the unit cache of one Python worker.
PAIR_MEMO = 500_000
UNIT_CACHE = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: token bytes -> id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class BytePairEncoder:
    """Exact byte-pair merges by backtracking over longest matches."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * self.size
        self.auto = ahocorasick.Automaton()
        self.parts = self._parts()
        self.joined = {p: i for i, p in enumerate(self.parts) if p is not None}
        for b, i in ranks.items():
            self.bytes[i] = b
            if len(b) == 1 or self.parts[i] is not None:
                self.auto.add_word(b.decode("latin-1"), (i, len(b) - 1))
        self.auto.make_automaton()
        self.length = [len(b) for b in self.bytes]
        self.memo: dict[int, bool] = {}

    def _parts(self) -> list[tuple[int, int] | None]:
        """The pair that each token is merged from: its encoding by lower ranks alone."""
        out: list[tuple[int, int] | None] = [None] * self.size
        for b, i in self.ranks.items():
            if len(b) < 2:
                continue
            seq = [bytes([x]) for x in b]
            while len(seq) > 2:
                r, at = min((self.ranks.get(seq[k] + seq[k + 1], self.size), k)
                            for k in range(len(seq) - 1))
                if r >= i:
                    break
                seq[at:at + 2] = [seq[at] + seq[at + 1]]
            if len(seq) == 2:
                out[i] = (self.ranks[seq[0]], self.ranks[seq[1]])
        return out

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side (memoised)."""
        key = left << 32 | right
        known = self.memo.get(key)
        if known is None:
            if len(self.memo) >= PAIR_MEMO:
                self.memo.clear()
            known = self.memo[key] = self._neighbours(left, right)
        return known

    def _neighbours(self, a: int, b: int) -> bool:
        """Undo the merges at the joint, the latest first.

        A pair across the joint that merges before the step undone last would
        have been taken in its place, so the two could not have met.
        """
        limit = self.size
        while True:
            if self.joined.get((a, b), self.size) < limit:
                return False
            if self.parts[b] is None or a > b and self.parts[a] is not None:
                if self.parts[a] is None:
                    return True
                limit, a = a, self.parts[a][1]
            else:
                limit, b = b + 1, self.parts[b][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        got = self.ranks.get(piece)
        if got is not None:
            return [got]
        at: list[list[int]] = [[] for _ in piece]
        for end, (token, length) in self.auto.iter(piece.decode("latin-1")):
            at[end - length].append(token)  # ends ascend, so the longest comes last
        out: list[int] = []
        place, n, sizes, memo = 0, len(piece), self.length, self.memo
        last = -1
        while place < n:
            choices = at[place]
            while choices:
                token = choices.pop()
                ok = last < 0 or memo.get(last << 32 | token)
                if ok is None:
                    ok = self.neighbours(last, token)
                if ok:
                    out.append(token)
                    place += sizes[token]
                    last = token
                    break
            else:  # nothing fits here: the token before was wrong
                place -= sizes[out.pop()]
                last = out[-1] if out else -1
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])


class TextEncoder:
    """Encodes texts: the split pattern, then each match's merges."""

    def __init__(self, ranks_path: str, pattern: str):
        self.bpe = BytePairEncoder(read_ranks(ranks_path))
        self.find = regex.compile(pattern).findall
        self.ids = UnitCache(self.encode_units, UNIT_CACHE)

    def encode(self, text: str) -> list[int]:
        one = self.bpe.encode_piece
        return [i for m in self.find(text) for i in one(m.encode())]

    def encode_units(self, texts: list[str]) -> list[bytes]:
        """Ids of each unit as little-endian 32-bit integers."""
        one, out = self.bpe.encode_piece, []
        for t in texts:
            # A run of letters below U+0250 after its space is one match of the pattern.
            ids = one(t.encode()) if t[1:].isalpha() and max(t) < "\u0250" and t[0] == " " \
                else self.encode(t)
            out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return self.bpe.decode(ids)


def encoder(ranks_path: str, pattern: str) -> TextEncoder:
    """One encoder per Python worker; the files are read where the task runs."""
    return kept(("byte_bpe", ranks_path, pattern), lambda: TextEncoder(ranks_path, pattern))


def _with(df: DataFrame, per_slice, fields: list[T.StructField]) -> DataFrame:
    """``df`` with columns that ``per_slice(rows, texts)`` computes from ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([*rows.columns, *per_slice(texts)],
                                                 names=names)

    clash = {f.name for f in fields}
    rest = df.select(*[c for c in df.columns if c not in clash])
    names = rest.columns + [f.name for f in fields]
    return rest.mapInArrow(run, T.StructType(rest.schema.fields + fields))


def encode_column(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with ``ids`` (array<int>) and ``n_tokens`` of its column ``text``.

    A null or empty text has no ids. Columns of ``df`` named like a new one are
    replaced. Rows stay as they are, repeated ones too.
    """
    def ids_of(texts: pa.Array) -> list[pa.Array]:
        enc = encoder(ranks_path, pattern)
        units = Units(texts)
        flat, at = gather(*enc.ids(units.texts), units.seq)
        ends = np.concatenate([[0], np.cumsum(at)])[units.bounds]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))
        return [lists, pa.array(np.diff(ends), pa.int64())]

    return _with(df, ids_of, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                              T.StructField("n_tokens", T.LongType())])


def encode_digests(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with ``n_tokens`` and digests of the ids and of the decoded bytes.

    ``ids_sha256`` is that of the decimal ids joined by one space,
    ``decoded_sha256`` that of the bytes that decoding the ids gives back.
    """
    def digests(texts: pa.Array) -> list[pa.Array]:
        enc = encoder(ranks_path, pattern)
        units = Units(texts)
        # All units' ids, each once: gathered in the order of the units.
        flat, sizes = gather(*enc.ids(units.texts), np.arange(len(units.texts)))
        ids, a = flat.tolist(), 0
        decimals: list[str] = []
        decoded: list[bytes] = []
        for b in np.cumsum(sizes).tolist():
            decimals.append(" ".join(map(str, ids[a:b])))
            decoded.append(enc.decode(ids[a:b]))
            a = b
        full = sizes[units.seq] > 0
        seq = units.seq[full]
        bounds = np.concatenate([[0], np.cumsum(full)])[units.bounds]
        n = np.concatenate([[0], np.cumsum(sizes[seq])])[bounds]
        out = [pa.array(np.diff(n), pa.int64())]
        for values, kind, gap in ((decimals, pa.large_string(), " "),
                                  (decoded, pa.large_binary(), b"")):
            lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()),
                                                  pa.array(values, kind).take(pa.array(seq)))
            data, offs = utf8(pc.binary_join(lists, pa.scalar(gap, kind)))
            view = memoryview(data)
            out.append(pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in
                                 zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]))
        return out

    return _with(df, digests, [T.StructField("n_tokens", T.LongType()),
                               T.StructField("ids_sha256", T.StringType()),
                               T.StructField("decoded_sha256", T.StringType())])


def decode_column(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with ``decoded`` (binary): the bytes of its column ``ids``; null for null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            enc = encoder(ranks_path, pattern)
            got = [None if x is None else enc.decode(x)
                   for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())],
                                             names=names)

    rest = df.drop("decoded")
    names = rest.columns + ["decoded"]
    return rest.mapInArrow(run, T.StructType(
        rest.schema.fields + [T.StructField("decoded", T.BinaryType())]))


__all__ = ["BytePairEncoder", "TextEncoder", "decode_column", "encode_column", "encode_digests",
           "encoder", "read_ranks"]
