"""Token ids of a corpus in wavelet-matrix shard files.

A shard holds the ids of some documents, end to end, as one bit-plane per bit of an
id, the highest first; after each plane the ids are parted, zeros before ones, in
stable order. With a count of ones before each block of a plane, one file answers
``access`` (the id at a place), ``rank`` / ``count`` (how often an id occurs in a
range) and ``select`` / ``occurrences`` (where), each in one step per plane.

File layout (all little-endian): ``WMX2``, u32 planes, u64 ids, u64 documents, then
three zstd frames with their u64 lengths: the directory (per document an i64 doc_id, an
i64 number of ids, a u8 that is 1 where doc_id is null), the counts (per plane an i64
number of ones before each block of BLOCK bytes, and in all) and the packed planes.

The corpus is ranged and sorted by doc_id (nulls first) and a hash of the text, so that
rows of one doc_id or of none are spread over as many ranges as they need. Each task writes
the shards of its range. A row of the written table is one shard file (``payload``) with its
place: ``part`` (the range), ``shard``, and ``before``, the ids of the same range before it.

Special tokens of the tokenizer that stand in a text are encoded as the library does by
default: as their ids.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import kept, let_go, text_slices
from .pretokens import UnitCache, Units, gather

MAGIC = b"WMX2"
#: Ids after which a shard ends (at the next end of a document).
SHARD_IDS = 1 << 22
#: Units whose ids a Python worker keeps.
UNIT_CACHE = 1_200_000
#: Characters of units that go to the library as one text.
JOINED_CHARS = 4000
#: Bytes of texts whose distinct units are looked up together.
UNIT_BYTES = 20 << 20
#: Ids of a plane that are parted at once, so that the places fit a core's cache.
PARTED = 1 << 15
BLOCK = 64  # bytes of a plane between two stored counts

SHARDS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("payload", T.BinaryType())])


class WaveletMatrix:
    """Bit-planes of a sequence of ids with rank and select."""

    def __init__(self, n: int, planes: np.ndarray, before: np.ndarray | None = None):
        """``planes``: packed bits, one row per plane, low bit of a byte first; ``before``: per
        plane the ones before each block, and in all (counted if they are not given)."""
        self.n, self.planes = n, planes
        self.before = self._counted(planes) if before is None else before
        self.zeros = n - self.before[:, -1]

    @staticmethod
    def _counted(planes: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(planes)
        pad = -ones.shape[1] % BLOCK
        blocks = np.pad(ones, ((0, 0), (0, pad))).reshape(len(planes), -1, BLOCK)
        blocks = blocks.sum(2, dtype=np.int64)
        return np.concatenate([np.zeros((len(planes), 1), np.int64),
                               np.cumsum(blocks, axis=1)], axis=1)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes = np.zeros((bits, -(-len(ids) // 8)), np.uint8)
        for k in range(bits):
            bit = cur & cur.dtype.type(1 << (bits - 1 - k)) != 0
            planes[k] = np.packbits(bit, bitorder="little")
            parted = np.empty_like(cur)
            zero, one = 0, len(cur) - int(np.count_nonzero(bit))
            for a in range(0, len(cur), PARTED):
                some, which = cur[a:a + PARTED], bit[a:a + PARTED]
                at = np.flatnonzero(which)
                np.take(some, at, out=parted[one:one + len(at)], mode="clip")
                one += len(at)
                at = np.flatnonzero(~which)
                np.take(some, at, out=parted[zero:zero + len(at)], mode="clip")
                zero += len(at)
            cur = parted
        return cls(len(ids), planes)

    def decode(self) -> np.ndarray:
        """The whole sequence: the planes' partings undone from the last to the first."""
        bits = len(self.planes)
        kind = np.uint16 if bits <= 16 else np.uint32
        cur = np.zeros(self.n, kind)
        for k in reversed(range(bits)):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            above, i, j = np.empty(self.n, kind), 0, int(self.zeros[k])
            cur[j:] |= kind(1 << (bits - 1 - k))
            for a in range(0, self.n, PARTED):
                some, which = above[a:a + PARTED], one[a:a + PARTED]
                at = np.flatnonzero(which)
                some[at] = cur[j:j + len(at)]
                j += len(at)
                at = np.flatnonzero(~which)
                some[at] = cur[i:i + len(at)]
                i += len(at)
            cur = above
        return cur.astype(np.uint32)

    def _rank1(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        block = (i >> 3) // BLOCK
        lo = block * BLOCK
        got = int(self.before[k, block])
        got += int(np.bitwise_count(self.planes[k, lo:i >> 3]).sum())
        if i & 7:
            got += (int(self.planes[k, i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        return got

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k in range(len(self.planes)):
            bit = int(self.planes[k, i >> 3]) >> (i & 7) & 1
            r = self._rank1(k, i)
            out = out << 1 | bit
            i = int(self.zeros[k]) + r if bit else i - r
        return out

    def _span(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Places of ``token``'s occurrences within [lo, hi) after the last plane."""
        bits = len(self.planes)
        if token >> bits:
            return 0, 0
        for k in range(bits):
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            if token >> (bits - 1 - k) & 1:
                lo, hi = int(self.zeros[k]) + a, int(self.zeros[k]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        a, b = self._span(token, lo, self.n if hi is None else hi)
        return b - a

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before place i."""
        return self.count(token, 0, i)

    def _select_bit(self, k: int, bit: int, r: int) -> int:
        """Place of the r-th (from 0) ``bit`` in plane k."""
        before = self.before[k]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK * 8, self.n) - before
        block = int(np.searchsorted(before, r, side="right")) - 1
        part = np.unpackbits(self.planes[k, block * BLOCK:(block + 1) * BLOCK],
                             bitorder="little")
        return block * BLOCK * 8 + int(np.flatnonzero(part == bit)[r - int(before[block])])

    def select(self, token: int, r: int) -> int:
        """Place of the r-th (from 0) occurrence of ``token``."""
        a, b = self._span(token, 0, self.n)
        if not 0 <= r < b - a:
            raise IndexError(r)
        i, bits = a + r, len(self.planes)
        for k in reversed(range(bits)):
            if token >> (bits - 1 - k) & 1:
                i = self._select_bit(k, 1, i - int(self.zeros[k]))
            else:
                i = self._select_bit(k, 0, i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, r) for r in range(self.count(token))]


def pack_shard(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, bits: int) -> bytes:
    """A shard file's bytes."""
    wm = WaveletMatrix.build(ids, bits)
    known = np.array([x or 0 for x in doc_ids], "<i8")
    null = np.array([x is None for x in doc_ids], np.uint8)
    zstd = zstandard.ZstdCompressor(level=1)
    directory = zstd.compress(known.tobytes() + lengths.astype("<i8").tobytes() + null.tobytes())
    counts = zstd.compress(wm.before.astype("<i8").tobytes())
    planes = zstd.compress(wm.planes)
    return b"".join([MAGIC, struct.pack("<IQQ", bits, len(ids), len(doc_ids)),
                     *(x for frame in (directory, counts, planes)
                       for x in (struct.pack("<Q", len(frame)), frame))])


def open_shard(payload: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """The matrix, doc_ids and numbers of ids per document of a shard file."""
    if payload[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    bits, n, docs = struct.unpack_from("<IQQ", payload, 4)
    at = 4 + struct.calcsize("<IQQ")
    frames = []
    for _ in range(3):
        size = struct.unpack_from("<Q", payload, at)[0]
        frames.append(zstandard.ZstdDecompressor().decompress(
            memoryview(payload)[at + 8:at + 8 + size]))
        at += 8 + size
    directory, counts, planes = frames
    known = np.frombuffer(directory, "<i8", docs)
    lengths = np.frombuffer(directory, "<i8", docs, 8 * docs)
    null = np.frombuffer(directory, np.uint8, docs, 16 * docs)
    ids = [None if z else k for k, z in zip(known.tolist(), null.tolist(), strict=True)]
    wm = WaveletMatrix(n, np.frombuffer(planes, np.uint8).reshape(bits, -1),
                       np.frombuffer(counts, "<i8").reshape(bits, -1))
    return wm, ids, lengths


class LibraryEncoder:
    """Ids by the tokenizers library, per distinct unit of text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.bits = max(1, (self.tok.get_vocab_size() - 1).bit_length())
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():  # one character of a token stands for one byte
            self.length[i] = len(token)
        self.one = [struct.pack("<I", i) for i in range(len(self.length))]
        self.ids = UnitCache(self.encode_units, UNIT_CACHE)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and the place of each text's first and of the end."""
        marked = np.zeros(len(texts), bool)
        for token in self.special:
            marked |= np.asarray(pc.match_substring(texts, token))
        plain = pc.if_else(pa.array(marked), "", texts) if marked.any() else texts
        units = Units(plain)
        flat, at = gather(*self.ids(units.texts), units.seq)
        ends = np.concatenate([[0], np.cumsum(at)])[units.bounds]
        if marked.any():  # cut at added tokens, which units know nothing of: by the library whole
            parts = np.split(flat, ends[1:-1])
            for k in np.flatnonzero(marked).tolist():
                found = self.tok.encode(texts[k].as_py(), add_special_tokens=False)
                parts[k] = np.array(found.ids, "<u4")
            flat = np.concatenate(parts)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return flat, ends

    def encode_units(self, texts: list[str]) -> list[bytes]:
        """Ids per unit as little-endian 32-bit integers.

        Units that begin with a space and a non-blank stay apart in one long text, so many go
        to the library as one; the bytes of each id tell where a unit ends.
        """
        out: list[bytes] = [b""] * len(texts)
        merge, one = self.tok.model.tokenize, self.one
        alone, joined, size = [], [[]], 0
        for k, t in enumerate(texts):
            if t[:1] == " " and t.isascii() and t[1:].isalpha():
                # One match of the split pattern; the model writes a space as U+0120.
                ids = [x.id for x in merge("\u0120" + t[1:])]
                out[k] = one[ids[0]] if len(ids) == 1 else struct.pack(f"<{len(ids)}I", *ids)
            elif t[:1] == " " and t[1:2].strip():
                joined[-1].append(k)
                size += len(t)
                if size > JOINED_CHARS:
                    joined.append([])
                    size = 0
            else:
                alone.append(k)
        whole = [texts[k] for k in alone]
        long = ["".join([texts[k] for k in ks]) for ks in joined]
        found = self.tok.encode_batch_fast(whole + long, add_special_tokens=False)
        for k, e in zip(alone, found, strict=False):
            out[k] = np.array(e.ids, "<u4").tobytes()
        for ks, e in zip(joined, found[len(alone):], strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum([len(texts[k].encode()) for k in ks])
            at = np.searchsorted(np.cumsum(self.length[ids]), ends, side="right")
            data, a = ids.tobytes(), 0
            for k, b in zip(ks, (4 * at).tolist(), strict=True):
                out[k] = data[a:b]
                a = b
        return out


def library_encoder(path: str) -> LibraryEncoder:
    return kept(("wavelet_ids", path), lambda: LibraryEncoder(path))


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int,
                 shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of ``docs`` (doc_id, text), ``end_id`` after each, as shards to ``path``.

    A null text is encoded as ''. Needs a byte-level tokenizer (see ``pretokens``).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        shard, before = 0, 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            all_ids = np.concatenate(ids)
            payload = pack_shard(all_ids, names, np.concatenate(lengths), enc.bits)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "shard": shard, "before": before, "n_ids": len(all_ids),
                  "payload": payload}],
                schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()),
                                  ("before", pa.int64()), ("n_ids", pa.int64()),
                                  ("payload", pa.binary())]))

        for batch in batches:
            for rows, texts in text_slices(batch, "text", UNIT_BYTES):
                flat, ends = enc.encode_texts(texts)
                ids.append(np.insert(flat, ends[1:], end_id))
                lengths.append(np.diff(ends) + 1)
                names.extend(rows.column(0).to_pylist())
                held += len(ids[-1])
                if held >= shard_ids:
                    yield flush()
                    shard, before, held = shard + 1, before + held, 0
                    ids, names, lengths = [], [], []
        if names:
            yield flush()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .withColumn("spread", F.xxhash64("text"))
     .repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread", "text")
     .drop("spread")
     .mapInArrow(run, SHARDS)
     .write.option("compression", "uncompressed").parquet(path))


def read_documents(spark: SparkSession, path: str,
                   fields: list[T.StructField], arrow: list[pa.DataType],
                   per_document: Callable[[np.ndarray], tuple]) -> DataFrame:
    """Per document of the shards at ``path``: doc_id, start, n_tokens and ``fields``.

    ``per_document`` gets a document's ids (uint32) and returns the values of ``fields``.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    # One row per range that was written: as many as the writing job had tasks.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    base, total = {}, 0
    for r in sorted(parts, key=lambda r: r["part"]):
        base[r["part"]] = total
        total += r["n"]
    names = ["doc_id", "start", "n_tokens"] + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part, before, payload in zip(*(batch.column(c).to_pylist() for c in
                                               ("part", "before", "payload")), strict=True):
                wm, doc_ids, lengths = open_shard(payload)
                ids = wm.decode()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                ids.flags.writeable = False
                values = [per_document(ids[a:b]) for a, b in
                          zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts + before + base[part]),
                     pa.array(lengths), *(pa.array(list(v), k) for v, k in
                                          zip(zip(*values, strict=True), arrow, strict=True))],
                    names=names)

    return shards.select("part", "before", "payload").mapInArrow(run, T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
         T.StructField("n_tokens", T.LongType()), *fields]))


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""
    return read_documents(spark, path, [T.StructField("ids_crc32", T.LongType())], [pa.int64()],
                          lambda ids: (zlib.crc32(ids.astype("<u4", copy=False)),))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, shard, place) of every occurrence of ``token``: rank and select, no decoding."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, before, payload in zip(*(c.to_pylist() for c in batch.columns),
                                                    strict=True):
                wm = open_shard(payload)[0]
                at = np.array(wm.occurrences(token), np.int64) + before
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(at), pa.int32()), pa.array([shard] * len(at), pa.int32()),
                     pa.array(at)], names=["part", "shard", "place"])

    return (spark.read.schema(SHARDS).parquet(path).select("part", "shard", "before", "payload")
            .mapInArrow(run, "part int, shard int, place long"))
