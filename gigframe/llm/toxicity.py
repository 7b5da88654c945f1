"""Toxicity scores from a learned lexicon, with misspellings and quotation.

The lexicon is learned from labelled texts: whole words, and word beginnings that
stand for many words, which toxic texts hold far more often than clean ones (by a
likelihood-ratio test on document counts). It is kept as a trie. Words of a text are
matched by the intersection of the trie with Levenshtein automata: a state is a set of
(trie node, edits so far), and states and transitions are made when a word first needs
them. Every match is judged in its window of words: inside quotation marks or beside a
verb of saying it counts as quoted. A logistic regression on the counts of plain,
misspelled and quoted matches gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import let_go, text_slices
from .components import written
from .labelled import fold, logistic_map, training_sample

#: Labelled rows of each class that a model is fitted on.
SAMPLE_PER_CLASS = 15_000
#: Toxic texts that a term needs, whatever their number.
LEAST_TEXTS = 3
PREFIX = range(3, 10)
#: Words on either side of a match that its context score reads.
WINDOW = 5
STATES = 50_000
WORD = re.compile(r"[^\W_]+")
#: Verbs of saying and quoting, in four languages.
SAYING = frozenset("""
said says say wrote writes called calls quote quoted quotes quoting reported word term
sagte sagt schrieb nannte zitat zitiert wort dit disait écrit appelé cite citation mot
dijo dice escribió llamó cita palabra
""".split())
OPEN, CLOSE = "\"“„«‹‘'", "\"”“»›’'"


def edits_for(word: str) -> int:
    """Misspellings allowed for a lexicon word: none under 5 letters, 2 from 9."""
    return 0 if len(word) < 5 else 1 if len(word) < 9 else 2


class FuzzyTrie:
    """Trie of a lexicon, intersected lazily with Levenshtein automata.

    ``match(word)`` gives 0 without a match, 1 for a word of the lexicon or one that
    begins with a beginning in it, 2 for a misspelling within ``edits_for``.
    """

    def __init__(self, words: list[str], beginnings: list[str]):
        self.kids: list[dict[str, int]] = [{}]
        self.most = [-1]  # edits allowed by any word below
        self.ends = [-1]  # edits allowed by the word that ends here
        self.begins = [False]
        for w in words:
            self.ends[self._add(w, edits_for(w))] = edits_for(w)
        for b in beginnings:
            self.begins[self._add(b, 0)] = True
        self._reset()

    def _add(self, word: str, edits: int) -> int:
        node = 0
        self.most[0] = max(self.most[0], edits)
        for c in word:
            if c not in self.kids[node]:
                self.kids[node][c] = len(self.kids)
                self.kids.append({})
                self.most.append(-1)
                self.ends.append(-1)
                self.begins.append(False)
            node = self.kids[node][c]
            self.most[node] = max(self.most[node], edits)
        return node

    def _reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.kind: list[int] = []
        self.start = self._state({(0, 0)})

    def _close(self, items: set[tuple[int, int]]) -> frozenset:
        """With letters of the lexicon word left out; only the fewest edits per node."""
        best: dict[int, int] = {}
        todo = sorted(items, key=lambda x: x[1])
        while todo:
            node, e = todo.pop(0)
            if e > self.most[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo += [(k, e + 1) for k in self.kids[node].values()]
        return frozenset(best.items())

    def _state(self, items: set[tuple[int, int]]) -> int:
        closed = self._close(items)
        if closed not in self.number:
            self.number[closed] = len(self.sets)
            self.sets.append(closed)
            self.steps.append({})
            exact = any(e == 0 and (self.begins[n] or self.ends[n] >= 0) for n, e in closed)
            near = any(e <= self.ends[n] for n, e in closed)
            self.kind.append(1 if exact else 2 if near else 0)
        return self.number[closed]

    def _step(self, state: int, c: str) -> int:
        items = set()
        for node, e in self.sets[state]:
            items.add((node, e + 1))
            for letter, k in self.kids[node].items():
                items.add((k, e if letter == c else e + 1))
            if self.begins[node] and e == 0:
                self.steps[state][c] = -1  # a beginning is complete: any rest will do
                return -1
        got = self.steps[state][c] = self._state(items) if items else -2
        return got

    def match(self, word: str) -> int:
        if len(self.sets) > STATES:
            self._reset()
        state, steps, sets = self.start, self.steps, self.sets
        for c in word:
            nxt = steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state == -1:
                return 1
            if state == -2 or not sets[state]:
                return 0
        return self.kind[state]


def in_quotes(text: str, start: int, end: int) -> bool:
    """Whether a span stands inside quotation marks on its line."""
    line = text.rfind("\n", 0, start) + 1
    stop = text.find("\n", end)
    before, after = text[line:start], text[end:stop if stop >= 0 else len(text)]
    if before.count('"') % 2 == 1 and '"' in after:
        return True
    for a, b in ("“”", "„“", "«»", "‹›", "‘’"):
        if before.rfind(a) > before.rfind(b) and b in after:
            return True
    return before[-1:] == "'" and after[:1] == "'"


def context_score(text: str, spans: list[tuple[int, int]], i: int) -> float:
    """1 and more: word ``i`` is quoted rather than meant."""
    score = 1.0 if in_quotes(text, *spans[i]) else 0.0
    near = spans[max(0, i - WINDOW):i] + spans[i + 1:i + 1 + WINDOW]
    said = sum(text[a:b].lower() in SAYING for a, b in near)
    marks = sum(text[max(0, a - 1):a] in OPEN and a > 0 or text[b:b + 1] in CLOSE and b < len(text)
                for a, b in near)
    return score + 0.5 * min(said, 2) + 0.25 * min(marks, 2)


def counts_of(text: str, trie: FuzzyTrie) -> tuple[int, int, int, int]:
    """Numbers of words, of plain matches, of misspelled and of quoted ones."""
    spans = [m.span() for m in WORD.finditer(text)]
    plain = near = quoted = 0
    for i, (a, b) in enumerate(spans):
        kind = trie.match(text[a:b].lower())
        if kind:
            if context_score(text, spans, i) >= 1:
                quoted += 1
            elif kind == 1:
                plain += 1
            else:
                near += 1
    return len(spans), plain, near, quoted


def features(n: np.ndarray) -> np.ndarray:
    """Regression inputs from rows of ``counts_of``."""
    words, plain, near, quoted = n.astype(float).T
    return np.stack([plain > 0, np.log1p(plain), np.minimum(1, plain / np.maximum(words, 1) * 20),
                     np.log1p(near), np.log1p(quoted), np.ones(len(n))], axis=1).astype(float)


#: Before any label: a plain match weighs most, a misspelled one less, a quoted one little.
PRIOR = np.array([2.0, 1.0, 1.0, 1.0, 0.3, -3.0])


@dataclass
class Model:
    words: list[str] = field(default_factory=list)
    beginnings: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())


def _terms(text: str) -> set[str]:
    """The distinct words of a text, and its words' beginnings, marked by a '*'."""
    words = {w.lower() for w in WORD.findall(text)}
    return words | {w[:k] + "*" for w in words for k in PREFIX if len(w) > k}


def _document_counts(texts: DataFrame) -> DataFrame:
    """(term, n): in how many texts; added up per task, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        total = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                total.update(_terms(t))
            if len(total) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()),
                                                  pa.array(total.values(), pa.int64())],
                                                 names=["term", "n"])
                total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()),
                                          pa.array(total.values(), pa.int64())],
                                         names=["term", "n"])

    return (texts.select("text").mapInArrow(run, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def _surprise(t: int, c: int, n_toxic: int, n_clean: int) -> float:
    """Likelihood-ratio statistic of a term's counts; 0 where clean texts hold it as often."""
    if t * (n_clean + 1) <= c * (n_toxic + 1):
        return 0.0
    def ll(k: float, n: float, p: float) -> float:
        return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)
    p = (t + c) / (n_toxic + n_clean)
    return 2 * (ll(t, n_toxic, t / n_toxic) + ll(c, n_clean, c / max(n_clean, 1))
                - ll(t, n_toxic, p) - ll(c, n_clean, p))


def evident(t: int, c: int, n_toxic: int, n_clean: int, least: float = 24.0,
            odds: float = 10.0) -> bool:
    """Whether a term in ``t`` toxic and ``c`` clean texts has enough evidence."""
    rate = ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1))
    return (t >= LEAST_TEXTS and rate >= odds
            and _surprise(t, c, n_toxic, n_clean) >= least)


def choose_lexicon(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int,
                   least: float = 24.0, odds: float = 10.0) -> tuple[list[str], list[str]]:
    """All words and beginnings with enough evidence, those in more toxic texts first.

    A beginning is taken where no single word explains it and no shorter one is as pure.
    """
    picked = {w for w, (t, c) in counts.items() if evident(t, c, n_toxic, n_clean, least, odds)}
    begins: set[str] = set()
    words = {w for w in picked if not w.endswith("*")}
    most: dict[str, int] = {}  # of the words that begin so
    for w in words:
        for k in PREFIX:
            most[w[:k]] = max(most.get(w[:k], 0), counts[w][0])

    def covered(word: str) -> bool:
        return any(word[:k] in begins for k in PREFIX)

    for b in sorted((w[:-1] for w in picked if w.endswith("*")), key=lambda x: (len(x), x)):
        if not covered(b) and most.get(b, 0) < 0.6 * counts[b + "*"][0]:
            begins.add(b)
    words = {w for w in words if not covered(w)}
    rank = sorted(words | {b + "*" for b in begins}, key=lambda w: (-counts[w][0], w))
    return ([w for w in rank if not w.endswith("*")],
            [w[:-1] for w in rank if w.endswith("*")])


def _evident_terms(train: DataFrame, n_toxic: int, n_clean: int) -> dict[str, tuple[int, int]]:
    """Toxic and clean counts of the terms with enough evidence; only these are collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [evident(t, c, n_toxic, n_clean) for t, c in
                    zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    toxic = _document_counts(train.where("label = 1")).where(F.col("n") >= LEAST_TEXTS)
    clean = _document_counts(train.where("label = 0")).withColumnRenamed("n", "c")
    found = (toxic.join(clean, "term", "left")
             .select("term", "n", F.coalesce("c", F.lit(0).cast("long")).alias("c"))
             .mapInArrow(run, "term string, n long, c long").collect())
    return {r["term"]: (r["n"], r["c"]) for r in found}


def _count_rows(trie: FuzzyTrie, texts: pa.Array) -> np.ndarray:
    """``counts_of`` for each text; only texts with a match are read word by word.

    All words of the slice are cut and numbered by Arrow, each distinct one is matched
    once, and a text without a match needs no more than its number of words.
    """
    cut = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}\p{M}]+")
    offs = np.asarray(cut.offsets, dtype=np.int64)
    offs = offs - offs[0]
    coded = cut.flatten().dictionary_encode()
    match = trie.match
    # Other marks inside a cut word (as in the pattern of WORD) split it again.
    hit = np.fromiter((any(match(p) for p in WORD.findall(w)) for w in
                       coded.dictionary.to_pylist()), bool, len(coded.dictionary))
    at = hit[np.array(coded.indices, dtype=np.int64)]
    before = np.concatenate([[0], np.cumsum(at)])
    some = np.flatnonzero(before[offs[1:]] > before[offs[:-1]])
    out = np.zeros((len(texts), 4), np.int64)
    out[:, 0] = np.diff(offs)
    for k in some.tolist():
        out[k] = counts_of(texts[k].as_py(), trie)
    return out


def _counted(docs: DataFrame, model: Model, extra: list[str]) -> DataFrame:
    """``extra`` columns of ``docs`` with the match counts of each text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.beginnings))
    kept = docs.select(*extra, "text")
    names = [*extra, "n_words", "n_plain", "n_misspelled", "n_quoted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        trie = FuzzyTrie(*shared.value)
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                n = _count_rows(trie, texts)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], *(pa.array(n[:, k]) for k in range(4))], names=names)

    return kept.mapInArrow(run, T.StructType(
        kept.schema.fields[:-1] + [T.StructField(x, T.LongType()) for x in names[-4:]]))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2,
        per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Lexicon and weights from a bounded sample of the labelled rows outside the held-out fold.

    Without labelled rows of both classes the lexicon is empty and the prior stands.
    """
    train = written(training_sample(docs, labels, "toxic", fold("doc_id", folds) != held_out,
                                    per_class), "toxic_train")
    sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model()
    words, begins = choose_lexicon(_evident_terms(train, sizes[1], sizes[0]),
                                   sizes[1], sizes[0])
    model = Model(words, begins)
    rows = np.array(_counted(train, model, ["label"]).collect(), np.int64)
    model.weights = logistic_map(features(rows[:, 1:]), rows[:, 0].astype(float), PRIOR, 1.0)
    return model


def score(docs: DataFrame, model: Model, folds: int = 4, held_out: int = 2,
          threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): held_out, score, predicted and the counts.

    Null and empty texts have no matches and the score of such; a null doc_id is not
    held out. Repeated rows stay.
    """
    n = ("n_words", "n_plain", "n_misspelled", "n_quoted")
    w = [float(x) for x in model.weights]
    words, plain, near, quoted = (F.col(x).cast("double") for x in n)
    z = (w[0] * (plain > 0).cast("double") + w[1] * F.log1p(plain)
         + w[2] * F.least(F.lit(1.0), plain / F.greatest(words, F.lit(1.0)) * 20)
         + w[3] * F.log1p(near) + w[4] * F.log1p(quoted) + w[5])
    return (_counted(docs, model, ["doc_id"])
            .withColumn("held_out", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)))
            .withColumn("score", 1 / (1 + F.exp(-z)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "held_out", "score", "predicted", *n))


def drop_toxic(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs`` (with ``text``) that score below ``threshold``, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m = shared.value
        trie = FuzzyTrie(m.words, m.beginnings)
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                z = features(_count_rows(trie, texts)) @ m.weights
                yield rows.filter(pa.array(1 / (1 + np.exp(-z)) < threshold))

    return docs.mapInArrow(run, docs.schema)
