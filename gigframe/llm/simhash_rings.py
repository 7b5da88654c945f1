"""SimHash near-duplicates found by pigeonring filtering, exact.

A document's fingerprint has 64 bits; a bit is 1 if over half of the hashes of the
document's word shingles (repeats included) have it. Two fingerprints link if at most
``most`` (2) bits differ.

The bits are dealt into SEGMENTS segments on a ring. If two fingerprints differ in at
most 2 bits, some segment starts a chain whose first l segments differ in at most
floor(2 l / SEGMENTS) bits, for every l (the pigeonring principle, in its strong form).
For small l that is 0: the first segments of the chain are equal, and they are the key
under which fingerprints meet. The longer prefixes of the chain prune the pairs that
meet, and only then are all 64 bits compared.

A key shared by more than BUCKET fingerprints is refined: the bits that the key leaves
open form a ring of their own, whose chains extend the key. Fingerprints are distinct,
so after some levels the open bits cannot hold that many. No pair is lost on the way
and no key gathers an unbounded number of rows.

Copies have one fingerprint, so they cost one row. The links' components are those of
the fingerprints.

Null and blank texts have the fingerprint zero, linked like any other. Rows that share
a doc_id are one document, also if their texts differ. Rows without a doc_id keep their
fingerprint, have no component and link nothing. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import text_slices, utf8
from .components import components, written
from .signature_tree import spanning_pairs
from .wordhash import Words

BITS = 64
SEED = 42
#: Segments of the ring; of a refined key's ring.
SEGMENTS, INNER_SEGMENTS = 7, 5
#: Fingerprints that may share a key before it is refined.
BUCKET = 2048
#: Groups up to this size are compared many at once.
SMALL = 32
#: Shingles whose bits are unpacked at once.
SHINGLES = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def slice_fingerprints(texts: pa.Array, n: int) -> np.ndarray:
    """The fingerprint (uint64) of each text."""
    data, offs = utf8(texts)
    words = Words(data, offs)
    bounds = words.per_doc()
    # The words with one space after each.
    lens = words.end - words.start
    at = np.cumsum(lens + 1) - (lens + 1)
    line = np.full(int((lens + 1).sum()), 32, np.uint8)
    inside = np.repeat(at - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
    line[inside] = _LOWER[data[words._word]]
    line = line.tobytes()
    # First and last word of each shingle, and its text.
    count = np.diff(bounds)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), grams)
    first = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams)
    first += bounds[:-1][doc]
    last = first + np.minimum(count, n)[doc] - 1
    ones = np.zeros((len(count), BITS), np.int64)
    digest = xxhash.xxh64_digest
    for a in range(0, len(first), SHINGLES):
        f, g, d = (x[a:a + SHINGLES] for x in (first, last, doc))
        spans = zip(at[f].tolist(), (at[g] + lens[g]).tolist(), strict=True)
        hashes = b"".join([digest(line[i:j], SEED) for i, j in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        starts = np.flatnonzero(np.diff(d, prepend=-1))
        ones[d[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > grams[:, None], axis=1).view(">u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """(doc_id, fp) per row of ``docs``: the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()),
                     pa.array(slice_fingerprints(texts, n).view(np.int64))],
                    names=["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, fp long"))


def ring(bits: list[int], segments: int) -> list[int]:
    """The masks of ``segments`` nearly equal runs of ``bits`` (bit numbers, in order)."""
    cuts = [len(bits) * k // segments for k in range(segments + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def chains(bits: list[int], segments: int, most: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Per start of a chain on the ring of ``bits``: the mask of its first segments, which
    must be equal, and (mask, budget) of each longer prefix."""
    parts = ring(bits, segments)
    out = []
    for start in range(segments):
        mask, key, rest = 0, 0, []
        for length in range(1, segments + 1):
            mask |= parts[(start + length - 1) % segments]
            budget = most * length // segments
            if budget == 0:
                key = mask
            else:
                rest.append((mask, budget))
        out.append((key, rest))
    return out


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _open_bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if not mask >> b & 1]


def _meet(rows: DataFrame, budgets: dict[int, list[tuple[int, int]]], most: int) -> DataFrame:
    """Links (a, b) among the fingerprints of each (mask, value): enough of them to connect
    all that link there."""
    key = ["mask", "value"]

    def links(fp: np.ndarray, i: np.ndarray, j: np.ndarray, masks: np.ndarray) -> np.ndarray:
        diff = fp[i] ^ fp[j]
        keep = np.ones(len(i), bool)
        for mask in np.unique(masks).tolist():
            here = np.flatnonzero(masks == mask)
            ok = np.ones(len(here), bool)
            for part, budget in budgets.get(mask, ()):
                ok &= np.bitwise_count(diff[here] & np.uint64(part)) <= budget
            keep[here] = ok
        keep[keep] = np.bitwise_count(diff[keep]) <= most
        return keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            starts = group_starts(table)
            yield found(table.slice(0, starts[-1]), starts)
            held = table.slice(starts[-1])
        if held is not None:
            yield found(held, np.array([0, len(held)]))

    def group_starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        new[:1] = True
        for k in key:
            x = table.column(k).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def found(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        fp = table.column("fp").to_numpy().view(np.uint64)
        masks = table.column("mask").to_numpy()
        lens = np.diff(starts)
        group = np.repeat(np.arange(len(lens)), lens)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        small = np.flatnonzero((lens <= SMALL)[group]) if len(lens) else group
        for step in range(1, min(SMALL, int(lens.max(initial=1)))):
            i, j = small[:-step], small[step:]
            same = group[i] == group[j]
            if not same.any():
                break
            i, j = i[same], j[same]
            ok = links(fp, i, j, masks[i])
            out.append((i[ok], j[ok]))
        for g in np.flatnonzero(lens > SMALL).tolist():
            a, n = int(starts[g]), int(lens[g])
            pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for top in range(0, n, 256):
                i, j = np.meshgrid(np.arange(top, min(top + 256, n)), np.arange(n), indexing="ij")
                i, j = i[i < j], j[i < j]
                ok = links(fp, a + i, a + j, masks[a + i])
                pairs.append((i[ok], j[ok]))
            i, j = spanning_pairs(n, *(np.concatenate(x) for x in zip(*pairs, strict=True)))
            out.append((a + i, a + j))
        i, j = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))
        x, y = fp[i].view(np.int64), fp[j].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))],
                                          names=["a", "b"])

    return (rows.select(*key, "fp").repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(run, "a long, b long"))


def _keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, value, fp): each fingerprint under each mask."""
    each = F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
    return rows.select("fp", each.alias("mask")).withColumn(
        "value", F.col("fp").bitwiseAND(F.col("mask")))


def fingerprint_links(spark: SparkSession, fps: DataFrame, most: int = 2) -> DataFrame:
    """Links (a, b) that connect all of ``fps`` (fp, distinct) which differ in at most
    ``most`` bits."""
    first = chains(list(range(BITS)), SEGMENTS, most)
    budgets = {_signed(key): rest for key, rest in first}
    keyed = written(_keyed(fps, [key for key, _ in first]), "keyed")
    masks = [key for key, _ in first]
    out = None
    while True:
        full = (keyed.groupBy("mask", "value").agg(F.count("*").alias("n"))
                .where(F.col("n") > BUCKET).select("mask", "value"))
        links = _meet(keyed.join(full, ["mask", "value"], "left_anti"), budgets, most)
        links = written(links.distinct(), "links")
        out = links if out is None else out.unionByName(links)
        inner = {m: [m | key for key, _ in chains(bits, INNER_SEGMENTS, most)]
                 for m in masks if len(bits := _open_bits(m)) > INNER_SEGMENTS}
        pairs = [(_signed(m), _signed(k)) for m, keys in inner.items() for k in keys]
        if not pairs:
            return out.distinct()
        finer = spark.createDataFrame(pairs, "mask long, finer long")
        keyed = written(
            keyed.join(full, ["mask", "value"], "left_semi").join(F.broadcast(finer), "mask")
            .select("fp", F.col("finer").alias("mask"),
                    F.col("fp").bitwiseAND(F.col("finer")).alias("value")).distinct(), "keyed")
        if keyed.isEmpty():
            return out.distinct()
        masks, budgets = sorted({k for keys in inner.values() for k in keys}), {}


def near_duplicates(spark: SparkSession, docs: DataFrame, n: int = 3, most: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id
    (the smallest doc_id that links reach, the document's own included)."""
    rows = written(fingerprints(docs, n), "fingerprints")
    known = rows.where("doc_id is not null")
    classes = written(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    links = fingerprint_links(spark, classes.select("fp"), most)
    # Rows that share a doc_id are one document.
    several = (known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z"))
               .where("a < z").select("doc_id", "a"))
    same = known.join(several, "doc_id").select("a", F.col("fp").alias("b")).where("a <> b")
    labels = components(spark, links.unionByName(same))
    classes = (classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
               .withColumn("label", F.coalesce("label", "fp")))
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "label").select("fp", "component_id")
    return rows.join(classes, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
