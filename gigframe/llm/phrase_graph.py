"""Phrases of a corpus by a weighted de Bruijn graph of words, exact.

Texts are cut into pieces at punctuation and line ends, pieces into words. The nodes of
the graph are runs of ``longest`` - 1 words, its edges the runs of ``longest`` words that
join overlapping nodes, weighted by their occurrences:

1. Every task builds the graph of its texts, one language at a time. Only edges and the
   ends of pieces are counted in the text. A node's count is the weight of its outgoing
   edges plus the pieces that end in it, and so on down to single words, so every shorter
   count comes from the flow and not from another pass.
2. The counts are dealt out by a hash of the phrase, as packed lists (one per cell of the
   hash), and added up by the phrase itself. A phrase costs one entry per graph, however
   often it occurs, so no phrase, word or language makes a task large.
3. Of the sums, edges and nodes of at least ``least`` occurrences are the strong graph.
   Unary paths of it are compacted: a node that one edge enters with the node's whole
   flow, and one leaves with it, has no count of its own. It goes with its path. What is
   left of the nodes, and all edges, are the candidates.
4. A candidate's score is a * a / (l * r) at its weakest cut. Shorter candidates that
   lie inside a longer one with at least half their count are dropped.

Null texts are empty; a null language is ``und``. Repeated rows count again. Empty tables
give no rows. Columns other than lang and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrowtext import small_batches, text_slices, utf8
from .components import written
from .wordhash import mix64

#: Bytes of one language's texts that make a graph, and of all that wait.
GRAPH_BYTES, WAITING_BYTES = 4 << 20, 12 << 20
#: Rows of an Arrow batch.
BATCH_ROWS = 2000
#: Words of a graph: their numbers and those of a run of three fit into 63 bits.
GRAPH_WORDS = (1 << 21) - 8
_ID = np.uint64(21)
#: Cells of the phrases' hash, at least; bytes of the table per cell.
CELLS, CELL_BYTES, MOST_CELLS = 1024, 16 << 20, 1 << 17
#: Parts of a language that are ranked apart before its best phrases meet.
SHARES = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[9, 32]] = True
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64((1 << 21) - 1)


class Pieces:
    """The words of some texts, and for each how many of its piece follow it (2: two or more)."""

    def __init__(self, texts: pa.Array):
        data, offs = utf8(texts)
        cut = _BREAK[data]
        word = ~(cut | _BLANK[data])
        n = len(data)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[offs[:-1][offs[:-1] < n]] = False
        after[offs[1:][offs[1:] > 0] - 1] = False
        start = np.flatnonzero(word & ~before)
        lens = np.flatnonzero(word & ~after) + 1 - start
        piece = np.searchsorted(np.flatnonzero(cut), start)
        piece += np.searchsorted(offs, start, side="right")
        self.follow = np.zeros(len(start), np.int8)
        self.follow[:-1] += piece[1:] == piece[:-1]
        self.follow[:-2] += piece[2:] == piece[:-2]
        ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        self.words = pa.LargeStringArray.from_buffers(
            len(start), pa.py_buffer(ends), pa.py_buffer(_LOWER[data[word]]))


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the weights of each added up."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - np.uint64(1)))
    if not len(starts):
        return keys, weights[:0]
    return keys[starts], np.add.reduceat(weights[order], starts)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - np.uint64(1)))
    return keys[starts], np.diff(starts, append=len(keys)).astype(np.int64)


def graph(words: np.ndarray, follow: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(code, count) of the edges, nodes and words of runs of three.

    ``words`` are the numbers of the words, ``follow`` as in ``Pieces``; words after the
    last ``follow`` are only looked at. A code has 21 bits per word, all ones for none.
    """
    n = len(follow)
    one = words.astype(np.uint64)
    at = np.flatnonzero(follow == 2)
    edges = _runs(one[at] << np.uint64(42) | one[at + 1] << _ID | one[at + 2])
    # A node's count: its outgoing edges and the pieces that end in it.
    at = np.flatnonzero(follow == 1)
    ends = _runs(one[at] << _ID | one[at + 1])
    nodes = _sums(np.concatenate([edges[0] >> _ID, ends[0]]), np.concatenate([edges[1], ends[1]]))
    # A word's count: the nodes that it starts and the pieces that end in it.
    ends = _runs(one[:n][follow == 0])
    single = _sums(np.concatenate([nodes[0] >> _ID, ends[0]]), np.concatenate([nodes[1], ends[1]]))
    return [edges, (nodes[0] << _ID | _NONE, nodes[1]),
            (single[0] << np.uint64(42) | _NONE << _ID | _NONE, single[1])]


def _split(code: np.ndarray) -> list[np.ndarray]:
    return [code >> np.uint64(42), code >> _ID & _NONE, code & _NONE]


def _packed(texts: pa.Array, lang: str, cells: int) -> Iterator[pa.RecordBatch]:
    """The phrases of ``texts`` with their counts, a row per cell that has some."""
    pieces = Pieces(texts)
    for a in range(0, len(pieces.words), GRAPH_WORDS):
        follow = pieces.follow[a:a + GRAPH_WORDS]
        coded = pieces.words.slice(a, len(follow) + 2).dictionary_encode()
        known = coded.dictionary
        parts = graph(coded.indices.to_numpy(), follow)
        code, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        word = _split(code)
        # The hash depends on the words alone, so that graphs agree about the cell.
        own = np.fromiter((zlib.crc32(w.encode()) for w in known.to_pylist()), np.uint64, len(known))
        own = np.append(own, np.uint64(1) << np.uint64(40))
        h = mix64(own[word[0]])
        for w in word[1:]:
            h = mix64(h * _BASE + own[np.minimum(w, np.uint64(len(known)))])
        cell = ((h >> np.uint64(40)) % np.uint64(cells)).astype(np.int32)
        order = np.argsort(cell.astype(np.uint16) if cells <= 1 << 16 else cell, kind="stable")
        code, count, cell = code[order], count[order], cell[order]
        del h, order
        phrase = pc.binary_join_element_wise(
            *[known.take(pa.array(w, mask=w == int(_NONE))) for w in
              (x.astype(np.int32) for x in _split(code))],
            pa.scalar(" ", pa.large_string()), null_handling="skip")
        data, offs = utf8(phrase)
        wide = np.int64 if int(count.max()) >> 31 else np.int32
        count, lens = count.astype(wide), np.diff(offs).astype(wide)
        starts = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
        size, payload = [], []
        for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            raw = b"".join((np.array([j - i, wide().itemsize], np.int64), count[i:j], lens[i:j],
                            data[offs[i]:offs[j]]))
            size.append(len(raw))
            payload.append(pa.compress(raw, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(size), pa.string()), pa.array(cell[starts[:-1]]),
             pa.array(size, pa.int64()), pa.array(payload, pa.binary())],
            names=["lang", "cell", "size", "payload"])


def _unpacked(size: list[int], payload: list[bytes]) -> pa.Table:
    counts, lens, texts = [], [], []
    for n, x in zip(size, payload, strict=True):
        raw = pa.decompress(x, n, codec="zstd", asbytes=True)
        k, w = np.frombuffer(raw, np.int64, 2).tolist()
        counts.append(np.frombuffer(raw, f"i{w}", k, 16))
        lens.append(np.frombuffer(raw, f"i{w}", k, 16 + w * k))
        texts.append(memoryview(raw)[16 + 2 * w * k:])
    ends = np.concatenate([[0], np.cumsum(np.concatenate(lens), dtype=np.int64)])
    phrase = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends),
                                              pa.py_buffer(b"".join(texts)))
    return pa.table({"phrase": phrase, "f": np.concatenate(counts).astype(np.int64)})


def cells_for(docs: DataFrame) -> int:
    """Cells that the table's estimated bytes need; any number gives the same counts."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(max(CELLS, size // CELL_BYTES), MOST_CELLS)


def phrase_counts(docs: DataFrame, least: int) -> DataFrame:
    """lang, phrase, f: phrases of one to three words that occur ``least`` times or more; and a
    row per language and cell whose phrase is null, with the cell's number of words as f."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    cells = cells_for(docs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}

        def graph_of(lang: str) -> Iterator[pa.RecordBatch]:
            size.pop(lang)
            yield from _packed(pa.concat_arrays(waiting.pop(lang)), lang, cells)
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for rows, texts in text_slices(batch, "text", GRAPH_BYTES):
                coded = pa.array(rows.column(0)).dictionary_encode()
                index = coded.indices.to_numpy()
                for k, lang in enumerate(coded.dictionary.to_pylist()):
                    own = texts.take(pa.array(np.flatnonzero(index == k)))
                    waiting.setdefault(lang, []).append(own)
                    size[lang] = size.get(lang, 0) + own.nbytes
                    if size[lang] >= GRAPH_BYTES:
                        yield from graph_of(lang)
                while sum(size.values()) > WAITING_BYTES:
                    yield from graph_of(max(size, key=size.get))
        for lang in list(size):
            yield from graph_of(lang)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size, payload = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if not size:
                return
            sums = _unpacked(size, payload).group_by("phrase").aggregate([("f", "sum")])
            size.clear()
            payload.clear()
            words = sums.filter(pc.invert(pc.match_substring(sums["phrase"], " ")))
            strong = sums.filter(pc.greater_equal(sums["f_sum"], least)).combine_chunks()
            total = pc.sum(words["f_sum"]).as_py() or 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[1]] * (len(strong) + 1), pa.string()),
                 pa.array([*strong["phrase"].to_pylist(), None], pa.string()),
                 pa.array([*strong["f_sum"].to_pylist(), total], pa.int64())],
                names=["lang", "phrase", "f"])

        for batch in batches:
            for lang, cell, n, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (cell, lang) != key:
                    yield from close()
                    key = (cell, lang)
                size.append(n)
                payload.append(x)
        yield from close()

    return (docs.mapInArrow(pack, "lang string, cell int, size long, payload binary")
            .repartition("cell").sortWithinPartitions("cell", "lang")
            .mapInArrow(add, "lang string, phrase string, f long"))


def _word(k: int) -> Column:
    return F.element_at("w", k)


def _pair(k: int) -> Column:
    return F.concat_ws(" ", _word(k), _word(k + 1))


def strong_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The nodes left when unary paths are compacted and nodes that mostly pass on one edge
    are dropped.

    ``nodes`` has lang, phrase, w, a; ``edges`` lang, phrase, w, a. A node on a unary path is
    entered and left by one edge with its whole count; its path has that count.
    """
    sides = edges.select("lang", "a", F.explode(F.array(
        F.struct(_pair(1).alias("phrase"), F.lit(False).alias("enters")),
        F.struct(_pair(2).alias("phrase"), F.lit(True).alias("enters")))).alias("at"))
    at = sides.groupBy("lang", F.col("at.phrase").alias("phrase")).agg(
        F.max(F.when(F.col("at.enters"), F.col("a"))).alias("entering"),
        F.max(F.when(~F.col("at.enters"), F.col("a"))).alias("leaving"))
    joined = nodes.join(at, ["lang", "phrase"], "left")
    unary = F.coalesce((F.col("entering") == F.col("a")) & (F.col("leaving") == F.col("a")),
                       F.lit(False))
    most = F.coalesce(F.greatest("entering", "leaving"), F.lit(0))
    return joined.where(~unary & (100 * most < 50 * F.col("a"))).select(nodes.columns)


def phrases(docs: DataFrame, least: int = 10, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` best phrases of each language.

    Candidates are phrases of two and three words that occur ``least`` times or more, less
    those of two words inside one of three with at least half their count.
    """
    with small_batches(docs.sparkSession, BATCH_ROWS):
        counts = written(phrase_counts(docs, least), "phrases")
    total = counts.where("phrase is null").groupBy("lang").agg(F.sum("f").alias("n"))
    strong = counts.where("phrase is not null")
    split = strong.withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    edges, nodes = split.where("size(w) = 3"), split.where("size(w) = 2")
    nodes = strong_nodes(nodes, edges)

    def cut(rows: DataFrame, k: int, left: Column, right: Column) -> DataFrame:
        return rows.select("lang", "phrase", "a", F.lit(k).alias("k"), left.alias("left"),
                           right.alias("right"))

    cuts = (cut(nodes, 1, _word(1), _word(2)).unionByName(cut(edges, 1, _word(1), _pair(2)))
            .unionByName(cut(edges, 2, _pair(1), _word(3))))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(strong.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)),
                         ["lang", side])
    # Decimals of 38 digits: exact up to counts of 10^15.
    score = F.expr("(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * 1000000BD)"
                   " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    best = (cuts.groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    # The best of each of a language's SHARES parts first: what is left of it fits in a task.
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    part = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    own = Window.partitionBy("lang", "part").orderBy(*order)
    best = (best.withColumn("part", part).withColumn("rank", F.row_number().over(own))
            .where(F.col("rank") <= top).drop("rank", "part"))
    order = Window.partitionBy("lang").orderBy(*order)
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    "score"))


#: The same as DuckDB SQL, for the query's parameters.
ORACLE = r"""
with pieces as (
  select lang, row_number() over () as piece,
         list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as w
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) as piece from documents)),
words as (select lang, piece, unnest(w) as w1, generate_subscripts(w, 1) as i from pieces),
runs as (
  select lang, w1, lead(w1, 1) over here as w2, lead(w1, 2) over here as w3
  from words window here as (partition by piece order by i)),
grams as (
  select lang, 1 as k, w1 as phrase, [w1] as v from runs
  union all select lang, 2, w1 || ' ' || w2, [w1, w2] from runs where w2 is not null
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3, [w1, w2, w3] from runs
            where w3 is not null),
f as (select lang, k, phrase, any_value(v) as v, count(*)::hugeint as f from grams group by all),
total as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
longer as (
  select lang, phrase, max(f) as f from (
    select lang, v[1] || ' ' || v[2] as phrase, f from f where k = 3 and f >= 10
    union all select lang, v[2] || ' ' || v[3], f from f where k = 3 and f >= 10)
  group by all),
cand as (
  select c.lang, c.k, c.phrase, c.v, c.f as a from f c
  left join longer x on c.k = 2 and x.lang = c.lang and x.phrase = c.phrase
  where c.k >= 2 and c.f >= 10 and coalesce(100 * x.f < 50 * c.f, true)),
cuts as (
  select c.*, j, array_to_string(v[1:j], ' ') as head, array_to_string(v[j + 1:k], ' ') as tail
  from cand c, (values (1), (2)) as js(j) where j < k),
scored as (
  select cuts.lang, cuts.phrase, a, j, x.f as l, y.f as r,
         (1000000::hugeint * a * a) // (x.f * y.f) as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = head and x.k = j
            join f y on y.lang = cuts.lang and y.phrase = tail and y.k = cuts.k - j),
best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from best)
select ranked.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r,
       n, score::bigint as score
from ranked join total using (lang) where rank <= 2000
"""
