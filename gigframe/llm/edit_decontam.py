"""Benchmark passages in documents, up to an edit budget (pigeonhole and Myers).

An item of m characters may differ from its place in a document by up to
k = floor(error_rate * m) insertions, deletions and substitutions. Cut into k + 1
pieces, at least one piece of it then stands in the document unchanged. All pieces of a
block of items are searched in one Aho-Corasick pass over a text, and each hit is
verified by Myers' bit-parallel distance on the window that the item could take.

Both sides are lower-cased and each run of white space becomes one space before they
are compared. Items are the stated query set; they are searched in blocks of bounded
size, each of which every text is run against.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import text_slices

#: Characters of items in one block, which is sent to every task.
BLOCK_CHARS = 4_000_000

FIELDS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("distance", T.LongType()),
    T.StructField("budget", T.LongType()), T.StructField("end", T.LongType())])


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' automaton of one item: best match within a text."""

    def __init__(self, item: str):
        self.m = len(item)
        self.peq: dict[str, int] = {}
        for i, c in enumerate(item):
            self.peq[c] = self.peq.get(c, 0) | 1 << i

    def best(self, text: str, limit: int) -> tuple[int, int] | None:
        """(distance, end) of the first nearest substring within ``limit`` edits."""
        mask, top = (1 << self.m) - 1, 1 << (self.m - 1)
        pv, mv, dist = mask, 0, self.m
        peq = self.peq.get
        found = None
        for at, c in enumerate(text, 1):
            eq = peq(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv) & mask
            mh = pv & xh
            if ph & top:
                dist += 1
            elif mh & top:
                dist -= 1
            ph = ph << 1 & mask
            mh = mh << 1 & mask
            pv = mh | ~(xv | ph) & mask
            mv = ph & xv
            if dist <= limit and (found is None or dist < found[0]):
                found = dist, at
        return found


class ItemSearch:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normal(text)
            if not text:
                continue
            k = int(error_rate * len(text))
            for place, piece in pieces(text, k):
                where.setdefault(piece, []).append((len(self.items), place))
            self.items.append((item_id, text, k, Pattern(text)))
        self.auto = ahocorasick.Automaton()
        for piece, at in where.items():
            self.auto.add_word(piece, (len(piece), at))
        if where:
            self.auto.make_automaton()
        self.any = bool(where)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, budget, end) of each item's first nearest place in ``text``.

        Windows of an item that overlap are verified as one.
        """
        if not self.any:
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (size, at) in self.auto.iter(text):
            for i, place in at:
                _, item, k, _ = self.items[i]
                start = end - size + 1 - place
                lo, hi = max(0, start - k), start + len(item) + k
                spans = windows.setdefault(i, [])
                if spans and lo <= spans[-1][1] and lo >= spans[-1][0]:
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
        out = []
        for i, spans in windows.items():
            item_id, item, k, pattern = self.items[i]
            exact = text.find(item)
            if exact >= 0:
                out.append((item_id, 0, k, exact + len(item)))
                continue
            best = None
            for lo, hi in spans:
                got = pattern.best(text[lo:hi], k)
                if got and (best is None or (got[0], lo + got[1]) < best):
                    best = got[0], lo + got[1]
            if best:
                out.append((item_id, best[0], k, best[1]))
        return sorted(out)


def item_blocks(items: DataFrame, max_chars: int = BLOCK_CHARS) -> list[list[tuple[int, str]]]:
    """The items (item_id, text) in blocks of at most ``max_chars``, in order of id.

    Null and blank items match nothing; repeated rows count once. An item without an
    id cannot be reported and is left out.
    """
    blocks: list[list[tuple[int, str]]] = [[]]
    held = 0
    rows = (items.select(F.col("item_id").cast("long").alias("item_id"), "text")
            .where("item_id is not null and text is not null").distinct()
            .orderBy("item_id", "text"))
    for r in rows.toLocalIterator():
        if held + len(r["text"]) > max_chars and blocks[-1]:
            blocks.append([])
            held = 0
        blocks[-1].append((r["item_id"], r["text"]))
        held += len(r["text"])
    return blocks


def matches(docs: DataFrame, items: DataFrame, error_rate: float = 0.05) -> DataFrame:
    """(doc_id, item_id, distance, budget, end) for each document and item found in it.

    ``end`` is the place after the match in the normalised text. Null and empty texts
    hold nothing. A repeated row of ``docs`` is reported each time; an item_id with
    several texts once per text found.
    """
    kept = docs.select("doc_id", "text")
    out = None
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast((block, error_rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = ItemSearch(*shared.value)
            for batch in batches:
                for rows, texts in text_slices(batch, "text"):
                    ids, found = [], []
                    for k, t in enumerate(texts.to_pylist()):
                        for hit in search.find(normal(t)):
                            ids.append(k)
                            found.append(hit)
                    cols = zip(*found, strict=True) if found else [[]] * 4
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(pa.array(ids, pa.int64())),
                         *(pa.array(list(c), pa.int64()) for c in cols)],
                        names=["doc_id", *FIELDS.names])

        part = kept.mapInArrow(run, T.StructType([kept.schema["doc_id"], *FIELDS.fields]))
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, error_rate: float = 0.05) -> DataFrame:
    """``docs`` without the rows that hold an item: every block is searched in turn."""
    schema, names = docs.schema, docs.columns
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast((block, error_rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = ItemSearch(*shared.value)
            for batch in batches:
                for rows, texts in text_slices(batch, "text"):
                    clean = [not search.find(normal(t)) for t in texts.to_pylist()]
                    yield rows.filter(pa.array(clean, pa.bool_())).select(names)

        docs = docs.mapInArrow(run, schema)
    return docs
