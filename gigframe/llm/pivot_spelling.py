"""Spelling variants of a corpus' words, grouped by pivotal grams, exact.

A word is near another if they differ by exactly one inserted, deleted or replaced code
point. A word's form is its most frequent near word, if that is at least twice as frequent;
its root is the end of the chain of forms.

1. Runs of letters are counted over all texts. (A fixed share of runs, by a hash of document
   and run, loses a letter first, so that misspellings of a known rate are there.)
2. Bigrams are ordered by the number of words that have them, rarest first. A word's prefix
   is its first three bigrams in this order (and others equal to the last of them). Three
   bigrams hold two that do not overlap: the pivots, chosen by dynamic programming as the
   pair of the least frequency in all.
3. One edit spoils at most one of two disjoint pivots. So of two near words, the one whose
   prefix ends earlier in the order has a pivot among the other's prefix, shifted by at most
   the difference of their lengths. Prefixes are indexed by (bigram, position, length) and
   probed with the pivots: with the same length and position, or one longer or shorter and
   the position as it is or moved along.
4. Words that meet are verified: in each group the words with one letter masked or left out
   are matched by hash, and every match is compared letter by letter. This is linear in the
   group. Groups of more than HOT rows are dealt out over PARTS parts of that hash.

Null texts have no words; a null doc_id counts as an empty one in the hash. Repeated rows
count again. Empty tables give no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import text_slices, utf8
from .components import written
from .wordhash import mix64

#: Words counted in a task before its sums go out.
KEPT_WORDS = 1 << 19
#: Rows of a group that one task matches in one go, and the parts of a larger one.
HOT, PARTS = 1 << 18, 64
#: Letters that are matched at once.
LETTERS = 1 << 20
#: Runs of more bytes are hashed one by one.
LONG_RUN = 48

_LETTER, _LOWER = np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER[65:91] += 32
_RANDOM = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 256, np.uint64) * np.uint64(2)
_RANDOM += np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()


def _crc32(state: np.ndarray, data: np.ndarray, start: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """crc32 of each run of ``data``, going on from the crc32 in ``state``."""
    out = state.copy()
    for k in np.flatnonzero(lens > LONG_RUN).tolist():
        out[k] = zlib.crc32(data[start[k]:start[k] + lens[k]], int(state[k]))
    order = np.argsort(-lens, kind="stable")
    order = order[np.searchsorted(-lens[order], -LONG_RUN):]
    at, left, s = start[order], lens[order], state[order] ^ np.uint32(0xFFFFFFFF)
    for k in range(int(left.max(initial=0))):
        m = int(np.searchsorted(-left, -k))
        x = s[:m]
        s[:m] = _CRC[(x ^ data[at[:m] + k]) & np.uint32(255)] ^ (x >> np.uint32(8))
    out[order] = s ^ np.uint32(0xFFFFFFFF)
    return out


def slice_words(ids: list, texts: pa.Array, every: int, least_len: int) -> pa.Array:
    """The words of some texts, one by one, of at least ``least_len`` code points."""
    data, offs = utf8(texts)
    lead = data == 0xC3  # of U+00C0 to U+00FF
    letter = _LETTER[data] | lead
    letter[1:] |= lead[:-1]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    before[offs[:-1][offs[:-1] < n]] = False
    after[offs[1:][offs[1:] > 0] - 1] = False
    start = np.flatnonzero(letter & ~before)
    lens = np.flatnonzero(letter & ~after) + 1 - start
    doc = np.searchsorted(offs, start, side="right") - 1
    low = _LOWER[data[letter]]
    at = np.cumsum(lens) - lens
    leads = np.concatenate([[0], np.cumsum(lead[letter])])
    points = lens - (leads[at + lens] - leads[at])
    first = np.fromiter((zlib.crc32(b"%s:" % (b"" if d is None else b"%d" % d)) for d in ids),
                        np.uint32, len(ids))
    crc = _crc32(first[doc], low, at, lens)
    cut = crc % np.uint32(every) == 0
    runs = pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(np.append(at, len(low)).astype(np.int64)), pa.py_buffer(low))
    hit = np.flatnonzero(cut & (points > least_len))
    shorter = []
    for word, h in zip(runs.take(pa.array(hit)).to_pylist(), crc[hit].tolist(), strict=True):
        k = h % len(word)
        shorter.append(word[:k] + word[k + 1:])
    whole = runs.filter(pa.array(~cut & (points >= least_len)))
    return pa.concat_arrays([whole, pa.array(shorter, pa.large_string())])


def word_counts(docs: DataFrame, every: int = 97, least_len: int = 5, least: int = 3) -> DataFrame:
    """(word, n): the words that occur ``least`` times or more, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []

        def summed() -> pa.Table:
            out = pa.concat_tables(kept).group_by("word").aggregate([("n", "sum")])
            return out.rename_columns(["word", "n"]).combine_chunks()

        def sent(table: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [table["word"].cast(pa.string()).combine_chunks(), table["n"].combine_chunks()],
                names=["word", "n"])

        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                counts = slice_words(rows.column(0).to_pylist(), texts, every,
                                     least_len).value_counts()
                kept.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
                if sum(map(len, kept)) > KEPT_WORDS:
                    kept[:] = [summed()]
                    if len(kept[0]) > KEPT_WORDS // 2:
                        yield sent(kept.pop())
        if kept:
            yield sent(summed())

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def _latin(words: pa.Array) -> list[bytes]:
    """Words of code points below 256, a byte for each."""
    return [w.encode("latin-1") for w in words.to_pylist()]


def gram_counts(words: DataFrame) -> np.ndarray:
    """In how many words each bigram (of 256 x 256) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, "word"):
                for w in _latin(texts):
                    x = np.frombuffer(w, np.uint8).astype(np.uint16)
                    total[np.unique(x[:-1] << 8 | x[1:])] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])],
                                         names=["gram", "n"])

    rows = (words.select("word").mapInArrow(run, "gram int, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())  # at most 90 x 90 rows
    out = np.zeros(1 << 16, np.int64)
    for r in rows:
        out[r["gram"]] = r["n"]
    return out


def prefix_and_pivots(word: bytes, counts: np.ndarray) -> tuple[list, list]:
    """The (position, bigram) of a word's prefix, and of its two pivots.

    ``word`` has at least four letters.
    """
    codes = [a << 8 | b for a, b in zip(word, word[1:], strict=False)]
    grams = sorted((int(counts[g]), g, p) for p, g in enumerate(codes))
    last = grams[2][:2]
    prefix = sorted((p, g, n) for n, g, p in grams if (n, g) <= last)
    # Least cost of one gram that ends before the next, then of two.
    one, two, waiting = None, None, []
    for p, g, n in prefix:
        while waiting and waiting[0][1] <= p - 2:
            one = min(one, waiting.pop(0)) if one else waiting.pop(0)
        if one:
            pair = (one[0] + n, one[1], p, one[2], g)
            two = min(two, pair) if two else pair
        waiting.append((n, p, g))
    return [(p, g) for p, g, _ in prefix], [(two[1], two[3]), (two[2], two[4])]


#: How a word of the index may differ from the word that probes: (length, position).
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def gram_rows(words: DataFrame, counts: np.ndarray, least_len: int = 5) -> DataFrame:
    """Index and probe rows: gram, pos, len (the group), longer, word, n.

    ``longer`` is null for the index, else how many letters the index's words have more.
    """
    shared = words.sparkSession.sparkContext.broadcast(counts)  # 65,536 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, "word", 1 << 20):
                row, gram, pos, size, longer = [], [], [], [], []
                for k, w in enumerate(_latin(texts)):
                    prefix, pivots = prefix_and_pivots(w, shared.value)
                    for p, g in prefix:
                        row.append(k), gram.append(g), pos.append(p), size.append(len(w))
                        longer.append(None)
                    for p, g in pivots:
                        for more, shift in SHIFTS:
                            if 0 <= p + shift <= len(w) + more - 2 and len(w) + more >= least_len:
                                row.append(k), gram.append(g), pos.append(p + shift)
                                size.append(len(w) + more), longer.append(more)
                own = rows.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram, pa.int32()), pa.array(pos, pa.int32()),
                     pa.array(size, pa.int32()), pa.array(longer, pa.int32()), *own.columns],
                    names=["gram", "pos", "len", "longer", "word", "n"])

    return words.select("word", "n").mapInArrow(
        run, "gram int, pos int, len int, longer int, word string, n long")


class _Spelled:
    """Words as letters in a row, and the hashes of all words with a letter changed."""

    def __init__(self, words: list[bytes], salt: np.ndarray):
        data = np.frombuffer(b"".join(words), np.uint8)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(lens) - lens
        self.row = np.repeat(np.arange(len(words)), lens)
        self.letter = np.arange(len(data)) - start[self.row]
        powers = np.full(int(lens.max(initial=1)), _BASE, np.uint64)
        powers[0] = 1
        self._term = _RANDOM[data] * np.cumprod(powers, dtype=np.uint64)[self.letter]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._term, dtype=np.uint64)])
        self._before = sums[:-1] - sums[start][self.row]
        self._own = sums[start + lens] - sums[start]
        self._salt = salt

    def masked(self, at: np.ndarray) -> np.ndarray:
        """Hashes of words with the letter ``at`` (its index in the row) masked."""
        row = self.row[at]
        x = (self._own[row] - self._term[at]) * np.uint64(3) + self._salt[row]
        return mix64(x + self.letter[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def shorter(self, at: np.ndarray) -> np.ndarray:
        """Hashes of words without the letter ``at``, equal to ``whole`` of that word."""
        row = self.row[at]
        after = self._own[row] - self._before[at] - self._term[at]
        return mix64(self._before[at] + after * _BASE_INVERSE + self._salt[row])

    def whole(self, rows: np.ndarray) -> np.ndarray:
        return mix64(self._own[rows] + self._salt[rows])


def _same(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal values."""
    order = np.argsort(x)
    lo, hi = (np.searchsorted(x[order], y, side=s) for s in ("left", "right"))
    j = np.repeat(np.arange(len(y)), hi - lo)
    i = np.arange(len(j)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[j]
    return order[i], j


def _salt(*group: np.ndarray) -> np.ndarray:
    """A hash of each row's group."""
    out = np.zeros(len(group[0]), np.uint64)
    for x in group:
        out = mix64(out * _BASE + x.astype(np.uint64) + np.uint64(1))
    return out


def near_rows(words: list[bytes], salt: np.ndarray, longer: np.ndarray, part: np.ndarray,
              parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index row, probe row) of one group whose words are near.

    ``salt`` is a hash of the row's group, ``longer`` is 9 for index rows. Rows with a
    ``part`` of 0 or more only count the hashes of that part of ``parts``.
    """
    s = _Spelled(words, salt)

    def letters(of: np.ndarray) -> np.ndarray:
        return np.flatnonzero(of[s.row])

    def here(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        p = part[rows]
        return (p < 0) | (hashes % np.uint64(parts) == p.astype(np.uint64))

    found = []

    def match(kind: int, index: tuple, probe: tuple) -> None:
        """Both sides are (rows, hashes, letter that is masked or left out, if any)."""
        (rx, hx, cx), (ry, hy, cy) = index, probe
        x, y = np.flatnonzero(here(hx, rx)), np.flatnonzero(here(hy, ry))
        i, j = _same(hx[x], hy[y])
        i, j = x[i], y[j]
        cut = cy[j] if cx is None else cx[i]
        found.append((rx[i], ry[j], s.letter[cut], np.full(len(i), kind, np.int8)))

    def masked(of: np.ndarray) -> tuple:
        at = letters(of)
        return s.row[at], s.masked(at), at

    def shorter(of: np.ndarray) -> tuple:
        at = letters(of)
        return s.row[at], s.shorter(at), at

    def whole(of: np.ndarray) -> tuple:
        rows = np.flatnonzero(of)
        return rows, s.whole(rows), None

    index = longer == 9
    match(0, masked(index), masked(longer == 0))
    match(1, shorter(index), whole(longer == 1))
    match(-1, whole(index), shorter(longer == -1))
    i, j, k, kind = (np.concatenate(x) for x in zip(*found, strict=True))
    _, once = np.unique(i * np.int64(len(words) + 1) + j, return_index=True)
    ok = []
    for x, y, at, more in zip(i[once].tolist(), j[once].tolist(), k[once].tolist(),
                              kind[once].tolist(), strict=True):
        x, y = words[x], words[y]
        if more:
            x, y = (x, y) if more > 0 else (y, x)
            ok.append(x[:at] + x[at + 1:] == y)
        else:
            ok.append(x != y and x[:at] == y[:at] and x[at + 1:] == y[at + 1:])
    once = once[np.array(ok, bool)]
    return i[once], j[once]


def _near(rows: DataFrame) -> DataFrame:
    """Near words (a, n_a, b, n_b), a before b, of each group (gram, pos, len, part)."""
    key = ["gram", "pos", "len", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = [], 0
        for batch in batches:
            held.append(batch)
            letters += batch.column(5).nbytes
            if letters < LETTERS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            ends = np.flatnonzero(starts(table))
            yield pairs(table.slice(0, ends[-1]))
            rest = table.slice(ends[-1])
            held, letters = rest.to_batches(), rest.column("word").nbytes
        if held:
            yield pairs(pa.Table.from_batches(held).combine_chunks())

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        new[:1] = True
        for k in key:
            x = table.column(k).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return new

    def pairs(table: pa.Table) -> pa.RecordBatch:
        words = _latin(table.column("word"))
        longer = table.column("longer").fill_null(9).to_numpy()
        salt = _salt(*[table.column(k).to_numpy() for k in key[:3]])
        i, j = near_rows(words, salt, longer, table.column("part").to_numpy(), PARTS)
        n = table.column("n").to_numpy()
        swap = np.array([words[x] > words[y] for x, y in zip(i, j, strict=True)], bool)
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        word = table.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [word.take(pa.array(i)), pa.array(n[i]), word.take(pa.array(j)), pa.array(n[j])],
            names=["a", "n_a", "b", "n_b"])

    return (rows.select(*key, "longer", "word", "n").repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(run, "a string, n_a long, b string, n_b long"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of large groups, each under the parts that its hashes fall into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _latin(batch.column(4))
            longer = batch.column(3).fill_null(9).to_numpy(zero_copy_only=False)
            s = _Spelled(words, _salt(*[batch.column(k).to_numpy() for k in range(3)]))
            every, rows = np.arange(len(s.row)), np.arange(len(words))
            own = [(s.row, s.masked(every), (longer == 9) | (longer == 0)),
                   (s.row, s.shorter(every), (longer == 9) | (longer == -1)),
                   (rows, s.whole(rows), (longer == 9) | (longer == 1))]
            cells = np.unique(np.concatenate(
                [r[ok[r]] * PARTS + (h[ok[r]] % np.uint64(PARTS)).astype(np.int64)
                 for r, h, ok in own]))
            taken = batch.take(pa.array(cells // PARTS))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array((cells % PARTS).astype(np.int32))],
                names=["gram", "pos", "len", "longer", "word", "n", "part"])

    return (rows.select("gram", "pos", "len", "longer", "word", "n")
            .mapInArrow(run, "gram int, pos int, len int, longer int, word string, n long, part int"))


def near_words(words: DataFrame, least_len: int = 5) -> DataFrame:
    """Pairs of near words (a, n_a, b, n_b), a before b, among ``words`` (word, n: distinct, of
    at least ``least_len`` >= 4 code points, all below 256)."""
    rows = written(gram_rows(words, gram_counts(words), least_len), "grams")
    group = ["gram", "pos", "len"]
    large = rows.groupBy(*group).agg(F.count("*").alias("rows")).where(F.col("rows") > HOT)
    large = written(large.select(*group), "large")
    pairs = _near(rows.join(large, group, "left_anti").withColumn("part", F.lit(-1)))
    if not large.isEmpty():
        pairs = pairs.unionByName(_near(_dealt(rows.join(large, group, "left_semi"))))
    return pairs.distinct()


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, form, root): the end of each word's chain of forms.

    ``forms`` has word, form; chains have no cycles. Each round doubles the distance that a
    root is away, so the rounds grow with the logarithm of the longest chain.
    """
    cur = forms.select("word", "form", F.col("form").alias("root"))
    while True:
        cur = written(cur, "roots")
        on = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = cur.join(on, "root", "left")
        if far.where("next is not null").isEmpty():
            return cur
        cur = far.select("word", "form", F.coalesce("next", "root").alias("root"))


def spelling_groups(spark: SparkSession, docs: DataFrame, every: int = 97, least_len: int = 5,
                    least: int = 3) -> DataFrame:
    """word, form, root, n, n_near, form_n per word that occurs ``least`` times or more."""
    words = written(word_counts(docs, every, least_len, least), "words")
    near = written(near_words(words, least_len), "near")
    both = (near.select(F.col("a").alias("word"), F.col("n_a").alias("n"),
                        F.col("b").alias("other"), F.col("n_b").alias("m"))
            .unionByName(near.select(F.col("b").alias("word"), F.col("n_b").alias("n"),
                                     F.col("a").alias("other"), F.col("n_a").alias("m"))))
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("best"))
    best = best.select("word", "n_near", (-F.col("best.less")).alias("form_n"),
                       F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.form"))
                       .alias("form"))
    best = written(best, "best")
    ends = roots(spark, best.where("form is not null").select("word", "form")).drop("form")
    return (words.join(best, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n")))
