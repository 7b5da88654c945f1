"""Similarity self-join of documents on word n-gram sets (Jaccard), exact.

A link is a pair of documents whose sets x, y satisfy den * |x & y| >= num * |x | y|.
The join returns the components that the links make and, if asked for, the number of
links of each document, never the pairs of a group of copies:

1. Every set is hashed to a class; documents with equal sets are one class.
2. Two sets can only link if they share a token among the first few of each in one
   fixed order (rare tokens first). The order comes from counts over all documents,
   in a table of fixed size; any order gives the same links. So classes meet in
   blocks, one per shared token; blocks with the same members are joined once.
3. In each block a signature tree (OR-ed token bitmaps, size ranges) is walked against
   itself. Its bounds drop pairs that cannot link; of the rest a spanning forest is
   verified on the texts, and links are contracted to components.
4. Blocks that still hold several components are walked again, and every pair between
   two components that the bounds leave is verified. Then no component is left apart.
5. For the number of links, all classes of a component are compared with each other, in
   chunks, by exact counts of shared tokens. No link crosses components, so none is left
   out; only sums per class leave a task.

Large blocks are cut into chunks: first each chunk meets itself and the first one, and
after the contraction only chunks of different components meet.

Empty sets (null or blank texts) link with nothing. Rows that share a doc_id are one
document. Rows without a doc_id keep their n_shingles and have no component. Equal
64-bit class hashes of different sets are not told apart (expected once in
10^9 documents: 3 percent).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import small_batches, text_slices, utf8
from .components import components, written
from .signature_tree import FANOUT, bitmap, possible_pairs, small_block_pairs, spanning_pairs
from .wordhash import Words, mix64, shingle_sets

#: The order's table: 2^22 counters, cut into slices to be summed by Spark.
COUNTER_BITS = 22
COUNTER_SLICES = 64
#: Members of a chunk of a large block.
CHUNK = 1024
#: Members of a chunk of a component whose links are counted, and cells of a token table.
LINK_CHUNK = 512
TABLE_CELLS = 4 << 20
#: Rows of an Arrow batch: a row has a bitmap of up to 32 KiB, or two texts.
BATCH_ROWS = 256
#: Bits per token in the bitmaps of blocks with inner nodes, where false pairs would multiply.
WIDE = 8


def _sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    return shingle_sets(Words(*utf8(texts)), n)


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def token_counts(docs: DataFrame, n: int) -> np.ndarray:
    """In how many documents the tokens of each counter occur, over all documents."""
    width = (1 << COUNTER_BITS) // COUNTER_SLICES

    def pack(total: np.ndarray) -> pa.RecordBatch:
        parts = total.astype(np.uint32).reshape(COUNTER_SLICES, width)
        used = [k for k in range(COUNTER_SLICES) if parts[k].any()]
        return pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()),
             pa.array([zlib.compress(parts[k].tobytes(), 1) for k in used], pa.binary())],
            names=["slice", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                sets = _sets(texts, n)
                total += np.bincount(_counter(np.concatenate(sets)), minlength=len(total))
        yield pack(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((COUNTER_SLICES, width), np.int64)
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] += np.frombuffer(zlib.decompress(c), np.uint32)
        total = np.minimum(total, 2**32 - 1)
        yield pack(total.reshape(-1))

    schema = "slice int, counts binary"
    rows = (docs.select("text").mapInArrow(count, schema)
            .repartition(COUNTER_SLICES, "slice").mapInArrow(add, schema).collect())
    out = np.zeros((COUNTER_SLICES, width), np.uint32)
    for r in rows:
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return out.reshape(-1)


def set_class(tokens: np.ndarray) -> int:
    """64-bit hash of a set."""
    h = mix64(np.array([mix64(tokens ^ np.uint64(0x51ED270B)).sum(dtype=np.uint64)
                        + np.uint64(len(tokens))], np.uint64))
    return int(h.view(np.int64)[0])


def signatures(docs: DataFrame, n: int, num: int, den: int, counts: np.ndarray) -> DataFrame:
    """Per document: size, class, first tokens in the order, a narrow and a wide bitmap.

    The last three are null for a class that the same task has met before.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, met = shared.value, set()
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                sets = _sets(texts, n)
                classes, first, bits, wide = [], [], [], []
                for s in sets:
                    c = set_class(s) if len(s) else None
                    classes.append(c)
                    if c is None or c in met:
                        for out in (first, bits, wide):
                            out.append(None)
                        continue
                    met.add(c)
                    keep = len(s) - -(-num * len(s) // den) + 1
                    rank = np.argsort(order[_counter(s)], kind="stable")[:keep]
                    first.append(s[rank].view(np.int64))
                    bits.append(bitmap(s))
                    wide.append(bitmap(s, WIDE))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(map(len, sets), pa.int64()),
                     pa.array(classes, pa.int64()), pa.array(first, pa.list_(pa.int64())),
                     pa.array(bits, pa.binary()), pa.array(wide, pa.binary())],
                    names=["doc_id", "n_shingles", "cls", "tokens", "bits", "wide"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, cls long, tokens array<long>, bits binary, wide binary")


def _walk(rows: DataFrame, num: int, den: int, sided: bool) -> DataFrame:
    """Pairs (a, b) left by the signature trees of each block of ``rows``.

    ``rows`` has token, i, j, two (the block), cls, n_shingles, bits, side and label.
    Unsided blocks give a spanning forest of the pairs that may link; sided ones give
    every pair between labels. Where ``two`` holds, only pairs between sides count. A
    block has at most about two chunks of rows. Blocks too small for an inner node are
    compared leaf by leaf, many at once.
    """
    key = ["token", "i", "j", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            starts = block_starts(table)
            yield walked(table.slice(0, starts[-1]), starts)
            held = table.slice(starts[-1])
        if held is not None:
            yield walked(held, np.array([0, len(held)]))

    def block_starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        new[:1] = True
        for k in key:
            x = table.column(k).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def walked(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        cls = table.column("cls").to_numpy()
        sizes = table.column("n_shingles").to_numpy()
        bits = table.column("bits").to_pylist()
        side = table.column("side").to_numpy()
        two = table.column("two").to_numpy()
        label = table.column("label").to_numpy()

        def wanted(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            ok = ~two[i] | (side[i] != side[j])
            return ok & (label[i] != label[j]) if sided else ok

        lens = np.diff(starts)
        small = lens <= FANOUT
        out = [small_block_pairs(starts[:-1][small], lens[small], sizes, bits, wanted, num, den)]
        for a, n in zip(starts[:-1][~small].tolist(), lens[~small].tolist(), strict=True):
            i, j = possible_pairs(sizes[a:a + n], bits[a:a + n], num, den,
                                  side[a:a + n] if two[a] else None)
            if sided:
                keep = label[a + i] != label[a + j]
                i, j = i[keep], j[keep]
            else:
                i, j = spanning_pairs(n, i, j)
            out.append((a + i, a + j))
        i, j = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(cls[i], cls[j])),
                                           pa.array(np.maximum(cls[i], cls[j]))], names=["a", "b"])

    cols = [*key, "cls", "n_shingles", "bits", "side", "label"]
    return (rows.select(*cols).repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(run, "a long, b long"))


def _verify(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs of classes (a, b) whose sets do link; ``texts`` has cls, text."""
    both = (pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text")), "a")
            .join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts_a in text_slices(batch, "text"):
                at = 0
                for part, texts_b in text_slices(rows, "text_b"):
                    yield linked(part, texts_a.slice(at, len(part)), texts_b)
                    at += len(part)

    def linked(rows: pa.RecordBatch, texts_a: pa.Array, texts_b: pa.Array) -> pa.RecordBatch:
        known: dict[int, np.ndarray] = {}
        for col, texts in ((0, texts_a), (1, texts_b)):
            ids = rows.column(col).to_pylist()
            first = {c: k for k, c in enumerate(ids) if c not in known}
            if first:
                sets = _sets(texts.take(pa.array(first.values())), n)
                known.update(zip(first, sets, strict=True))
        keep = []
        for a, b in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            x, y = known[a], known[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(den * both >= num * (len(x) + len(y) - both))
        return rows.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _first_blocks(members: DataFrame) -> DataFrame:
    """Blocks (c, c) and (0, c) of each token's chunks c."""
    chunks = F.ceil(F.col("members") / CHUNK)
    c = F.pmod(F.xxhash64("cls"), chunks).cast("int")
    own = F.array(F.struct(c.alias("i"), c.alias("j"), F.lit(False).alias("two"),
                           F.lit(False).alias("side")))
    hub = F.when(c == 0, F.transform(F.sequence(F.lit(1), (chunks - 1).cast("int")),
                                     lambda k: F.struct(F.lit(0).alias("i"), k.alias("j"),
                                                        F.lit(True).alias("two"),
                                                        F.lit(True).alias("side"))))
    hub = hub.otherwise(F.array(F.struct(F.lit(0).alias("i"), c.alias("j"),
                                         F.lit(True).alias("two"), F.lit(False).alias("side"))))
    at = F.when(chunks > 1, F.concat(own, hub)).otherwise(own)
    return members.withColumn("at", F.explode(at)).select(
        "token", "cls", F.lit(0).cast("long").alias("label"), "n_shingles", "bits", "at.*")


def _second_blocks(members: DataFrame) -> DataFrame:
    """Of tokens with several labels: chunks outside the commonest label against each
    other and against that label's chunks."""
    per = members.groupBy("token", "label").count()
    top = per.groupBy("token").agg(F.max(F.struct("count", "label")).alias("top"),
                                   F.sum("count").alias("all"), F.count("*").alias("labels"))
    top = top.where("labels > 1").select(
        "token", F.col("top.label").alias("big"),
        F.ceil(F.col("top.count") / CHUNK).cast("int").alias("n_big"),
        F.ceil((F.col("all") - F.col("top.count")) / CHUNK).cast("int").alias("n_rest"))
    rows = members.join(top, "token").withColumn("is_big", F.col("label") == F.col("big"))
    c = F.pmod(F.xxhash64("cls"), F.when(F.col("is_big"), F.col("n_big"))
               .otherwise(F.col("n_rest"))).cast("int")
    rows = rows.withColumn("c", c)

    def block(i, j, two, side):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(two).alias("two"), side.alias("side"))

    def upto(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    c = F.col("c")
    # With the commonest label: blocks (chunk of the rest, chunk of the label).
    big = F.transform(upto("n_rest"), lambda k: block(k, -1 - c, True, F.lit(False)))
    rest = F.concat(
        F.transform(upto("n_big"), lambda k: block(c, -1 - k, True, F.lit(True))),
        F.transform(upto("n_rest"), lambda k: block(F.least(c, k), F.greatest(c, k), False,
                                                    F.lit(False))))
    return (rows.withColumn("at", F.explode(F.when(F.col("is_big"), big).otherwise(rest)))
            .select("token", "cls", "label", "members", "at.*"))


def _linked_weight(sets: list[np.ndarray], size: np.ndarray, first: int, num: int,
                   den: int) -> np.ndarray:
    """Per set, the sizes of the others that it links with, added up.

    With ``first`` above 0 only pairs of one of the first so many sets and one of the rest.
    """
    lens = np.array([len(s) for s in sets], np.int64)
    k = first or len(sets)
    if len(sets) == 2:
        both = np.array([[len(np.intersect1d(*sets, assume_unique=True))]])
        rows, cols = np.array([0]), np.array([1])
    else:
        rows = np.arange(k)
        cols = np.arange(k, len(sets)) if first else rows
        tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), lens)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        both = np.zeros((len(rows), len(cols)), np.int64)
        width = max(1, TABLE_CELLS // len(sets))
        for a in range(0, len(tokens), width):
            lo, hi = np.searchsorted(column, [a, a + width])
            held = np.zeros((len(sets), min(width, len(tokens) - a)), np.float32)
            held[owner[lo:hi], column[lo:hi] - a] = 1
            both += (held[rows] @ held[cols].T).astype(np.int64)
    links = den * both >= num * (lens[rows][:, None] + lens[cols][None, :] - both)
    out = np.zeros(len(sets), np.int64)
    if first or len(sets) == 2:
        out[rows] = links @ size[cols]
        out[cols] = size[rows] @ links
    else:
        np.fill_diagonal(links, False)
        out = links @ size
    return out


def _class_links(members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(cls, n): documents in other classes that each class links with.

    ``members`` has label, cls, size and text, where a text may belong to another class
    of its document; every class comes with its own text too.
    """
    per = members.groupBy("label").agg(F.count("*").alias("all")).where("all > 1").select(
        "label", F.ceil(F.col("all") / LINK_CHUNK).cast("int").alias("chunks"))
    c = F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")
    at = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                     lambda k: F.struct(F.least(F.col("c"), k).alias("i"),
                                        F.greatest(F.col("c"), k).alias("j")))
    key = ["label", "i", "j"]
    rows = (members.join(per, "label").withColumn("c", c).withColumn("at", F.explode(at))
            .select("label", "at.*", "c", "cls", "size", "text")
            .repartition(*key).sortWithinPartitions(*key, "c", "cls"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at, met = None, [], set()
        done: tuple[list, list] = ([], [])

        def close() -> None:
            if len(at) > 1:
                chunk = np.array([x[0] for x in at])
                first = int((chunk == block[1]).sum()) if block[1] != block[2] else 0
                if block[1] == block[2] or 0 < first < len(at):
                    found = _linked_weight([x[3] for x in at],
                                           np.array([x[2] for x in at], np.int64), first, num, den)
                    some = np.flatnonzero(found)
                    done[0].extend(at[k][1] for k in some.tolist())
                    done[1].extend(found[some].tolist())
            at.clear()
            met.clear()

        def sums() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()),
                                              pa.array(done[1], pa.int64())], names=["cls", "n"])
            done[0].clear()
            done[1].clear()
            return out

        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                cols = (x.to_pylist() for x in part.columns[:6])
                for label, i, j, c, cls, size, s in zip(*cols, _sets(texts, n), strict=True):
                    if (label, i, j) != block:
                        close()
                        block = (label, i, j)
                    if cls not in met and set_class(s) == cls:
                        met.add(cls)
                        at.append((c, cls, size, s))
            yield sums()
        close()
        yield sums()

    return (rows.mapInArrow(run, "cls long, n long").groupBy("cls").agg(F.sum("n").alias("n")))


def jaccard_components(spark: SparkSession, docs: DataFrame, n: int = 5, num: int = 4,
                       den: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``docs`` has doc_id and text; words are lower-cased (A-Z) and cut at ASCII blanks.
    Links have similarity num / den or more on sets of ``n`` consecutive words.
    component_id is the smallest doc_id that links reach, the document's own included.
    """
    return _join(spark, docs, n, num, den, False)


def jaccard_links(spark: SparkSession, docs: DataFrame, n: int = 5, num: int = 4,
                  den: int = 5) -> DataFrame:
    """``jaccard_components`` with n_links: how many other documents a row's set links with.

    Copies count one by one. A document that has several different texts under its doc_id
    counts once for each that links. 0 for empty sets, null without a doc_id.
    """
    return _join(spark, docs, n, num, den, True)


def _join(spark: SparkSession, docs: DataFrame, n: int, num: int, den: int,
          count: bool) -> DataFrame:
    with small_batches(spark, BATCH_ROWS):
        return _joined(spark, docs, n, num, den, count)


def _joined(spark: SparkSession, docs: DataFrame, n: int, num: int, den: int,
            count: bool) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = written(signatures(docs, n, num, den, token_counts(docs, n)), "signatures")
    postings = sig.select(F.explode("tokens").alias("token"), "cls")
    shared = (postings.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
              .where("lo < hi").select("token"))
    blocks = written(postings.join(shared, "token"), "blocks").distinct()
    canon = (blocks.groupBy("token")
             .agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("cls")).alias("x"),
                  F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"))
             .groupBy("members", "x", "y").agg(F.min("token").alias("token")))
    shape = (sig.where("bits is not null").groupBy("cls")
             .agg(F.min("n_shingles").alias("n_shingles"), F.min("bits").alias("bits"),
                  F.min("wide").alias("wide")))
    blocks = written(blocks.join(canon.select("token", "members"), "token"), "blocks")

    def with_shape(members: DataFrame) -> DataFrame:
        return members.join(shape, "cls").withColumn(
            "bits", F.when(F.col("members") <= FANOUT, F.col("bits")).otherwise(F.col("wide"))
        ).drop("wide")

    pairs = written(_walk(_first_blocks(with_shape(blocks)), num, den, False).distinct(), "pairs")
    # Classes that may link with something; in a cut block not all chunks have met yet.
    alive = written(pairs.select(F.col("a").alias("cls")).union(pairs.select("b"))
                    .union(blocks.where(F.col("members") > CHUNK).select("cls")).distinct(),
                    "alive")
    owners = (sig.where("cls is not null and doc_id is not null").join(alive, "cls")
              .groupBy("cls").agg(F.min("doc_id").alias("doc_id")))
    texts = written(docs.join(owners, "doc_id").select("cls", "text"), "texts")
    links = written(_verify(pairs, texts, n, num, den), "links")
    labels = components(spark, links)

    rest = blocks.join(alive, "cls", "left_semi").join(
        labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls"))
    more = written(_walk(with_shape(_second_blocks(rest)), num, den, True).distinct()
                   .join(pairs, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(_verify(more, texts, n, num, den))
    # Rows that share a doc_id are one document.
    same = (sig.where("cls is not null and doc_id is not null").groupBy("doc_id")
            .agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a < b"))
    same = (same.join(sig.select("doc_id", "cls"), "doc_id").select("a", F.col("cls").alias("b")))
    labels = components(spark, links.unionByName(same))

    classes = (sig.where("cls is not null and doc_id is not null").groupBy("cls")
               .agg(F.min("doc_id").alias("least")))
    classes = (classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
               .withColumn("label", F.coalesce("label", "cls")))
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    extra = []
    if count:
        size = (sig.where("cls is not null and doc_id is not null").select("cls", "doc_id")
                .distinct().groupBy("cls").agg(F.count("*").alias("size")))
        classes = written(classes.join(size, "cls"), "classes")
        members = classes.select("label", "cls", "size").join(texts, "cls")
        links = written(_class_links(members, n, num, den), "links")
        classes = classes.join(links, "cls", "left").withColumn(
            "n_links", F.col("size") - 1 + F.coalesce("n", F.lit(0)))
        extra = ["n_links"]
    classes = classes.join(least, "label").select("cls", "component_id", *extra)
    found = sig.select("doc_id", "n_shingles", "cls").join(classes, "cls", "left")
    links = [F.when(F.col("doc_id").isNotNull(), F.coalesce(x, F.lit(0))).alias(x) for x in extra]
    return found.select("doc_id", "n_shingles",
                        F.when(F.col("doc_id").isNotNull(),
                               F.coalesce("component_id", "doc_id")).alias("component_id"), *links)


def keep_one(spark: SparkSession, docs: DataFrame, n: int = 5, num: int = 4,
             den: int = 5) -> DataFrame:
    """``docs`` without the documents whose component has a smaller doc_id.

    Rows without a doc_id stay.
    """
    found = jaccard_components(spark, docs, n, num, den)
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
