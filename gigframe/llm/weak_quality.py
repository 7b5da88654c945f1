"""Quality rules as weak supervision.

Each rule votes good (1), bad (0) or abstains (-1) on a document. Instead of asking that
all rules pass, expectation-maximisation estimates how often each rule errs, from how
the rules agree over the whole corpus, and a document is judged by its posterior
probability of being good. All that the estimate needs is how many documents cast each
combination of votes, which Spark counts; there are at most 3 to the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import text_slices, utf8
from .components import written
from .wordhash import Words, ngram_hashes

#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_stops", "n_adjacent", "n_capital_words", "n_distinct"]


def repeat_words(h: np.ndarray, bounds: np.ndarray, n: int = 3) -> np.ndarray:
    """Per document, its words inside ``n``-word windows that occur in it twice or more."""
    out = np.zeros(len(bounds) - 1, np.int64)
    grams = ngram_hashes(h, n)
    for d, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b - a <= n:
            continue
        _, back, count = np.unique(grams[a:b - n + 1], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[back] > 1)
        if len(twice):
            inside = np.zeros(b - a, bool)
            for k in range(n):
                inside[twice + k] = True
            out[d] = int(inside.sum())
    return out


def text_counts(texts: pa.Array) -> list[np.ndarray]:
    """The columns of COUNTS for each text."""
    data, offs = utf8(texts)
    w = Words(data, offs)
    h = w.hashes()
    bounds = w.per_doc()
    n = len(texts)

    def per_doc(of: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=at, minlength=n).astype(np.int64)

    def bytes_per_doc(mask: np.ndarray) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(mask)])
        return before[offs[1:]] - before[offs[:-1]]

    lead = (data & 0xC0) != 0x80  # the first byte of each code point
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS.encode())] = True
    stops = np.zeros(256, bool)
    stops[list(b".!?")] = True
    upper = (data >= 65) & (data <= 90)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    lens = w.end - w.start
    if len(h):
        runs = np.cumsum(lens) - lens
        capital = (np.add.reduceat(upper[w._word], runs, dtype=np.int64) * 2 > lens) & (lens > 1)
    else:
        capital = np.zeros(0, bool)
    dup, lines, distinct = (np.zeros(n, np.int64) for _ in range(3))
    for k in range(n):
        distinct[k] = len(np.unique(h[bounds[k]:bounds[k + 1]]))
        own = [x for x in texts[k].as_py().encode().split(b"\n") if x.split()]
        lines[k] = len(own)
        dup[k] = len(own) - len(set(own))
    return [np.diff(bounds), bytes_per_doc(lead & w._word), bytes_per_doc(symbols[data]), dup,
            repeat_words(h, bounds), lines, bytes_per_doc(stops[data]), per_doc(w.doc, again),
            per_doc(w.doc, capital), distinct]


def count_columns(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with the COUNTS of its column ``text`` (null as '')."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], *(pa.array(c, pa.int64()) for c in text_counts(texts))],
                    names=names)

    kept = docs.select(*keep, "text")
    names = [*keep, *COUNTS]
    return kept.mapInArrow(run, T.StructType(
        kept.schema.fields[:-1] + [T.StructField(c, T.LongType()) for c in COUNTS]))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, 0).when(good, 1).otherwise(-1).cast("int")


def rules() -> dict[str, Column]:
    """Votes from the counts; each rule is sure only at its two ends."""
    c = {k: F.col(k) for k in COUNTS}
    n = F.greatest(c["n_words"], F.lit(1))
    long_enough = c["n_words"] >= 50
    return {
        "symbols": _vote(c["n_symbols"] > 0.15 * n, (c["n_symbols"] < 0.03 * n) & long_enough),
        "symbol_share": _vote(c["n_symbols"] > 0.03 * c["word_chars"],
                              (c["n_symbols"] < 0.005 * c["word_chars"]) & long_enough),
        "repeats": _vote(c["n_repeat_words"] > 0.4 * n,
                         (c["n_repeat_words"] < 0.2 * n) & long_enough),
        "adjacent": _vote(c["n_adjacent"] > 0.15 * n, (c["n_adjacent"] < 0.05 * n) & long_enough),
        "capitals": _vote(c["n_capital_words"] > 0.3 * n,
                          (c["n_capital_words"] < 0.1 * n) & long_enough),
        "distinct": _vote(c["n_distinct"] < 0.15 * n, c["n_distinct"] > 0.4 * n),
        "dup_lines": _vote((c["n_dup_lines"] > 0.5 * c["n_lines"]) & (c["n_lines"] >= 4),
                           (c["n_dup_lines"] == 0) & (c["n_lines"] >= 3)),
        "sentences": _vote((c["n_stops"] > 0.5 * n) | (c["n_stops"] < 0.005 * n),
                           (c["n_stops"] > 0.02 * n) & (c["n_stops"] < 0.25 * n)),
        "word_length": _vote((c["word_chars"] > 12 * n) | (c["word_chars"] < 2 * n),
                             (c["word_chars"] > 3 * n) & (c["word_chars"] < 9 * n)),
    }


@dataclass
class RuleModel:
    """``prior``: share of good documents; ``table[r, y, v]``: how often rule r casts
    vote v (bad, good, abstain) on a document of quality y."""

    prior: float
    table: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        at = np.where(votes < 0, 2, votes)
        r = np.arange(votes.shape[1])
        logs = np.log(self.table)
        z = (np.log(self.prior) - np.log1p(-self.prior)
             + (logs[r, 1, at] - logs[r, 0, at]).sum(1))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def estimate(votes: np.ndarray, weight: np.ndarray, steps: int = 200,
             tolerance: float = 1e-9) -> RuleModel:
    """EM over vote combinations and their numbers of documents.

    Starts by doubting documents with bad votes, the more the further, and keeps a weak
    prior that votes are right more often than wrong, so that 'good' stays good.
    """
    n_rules = votes.shape[1]
    at = np.where(votes < 0, 2, votes)
    pseudo = np.tile(np.array([[[3.0, 1.0, 2.0], [0.2, 3.8, 2.0]]]), (n_rules, 1, 1))
    p = 0.9 * np.power(0.3, (votes == 0).sum(1))
    model = RuleModel(0.8, pseudo / pseudo.sum(2, keepdims=True))
    for _ in range(steps if len(votes) else 0):
        table = pseudo.copy()
        for y, q in ((1, p * weight), (0, (1 - p) * weight)):
            for r in range(n_rules):
                table[r, y] += np.bincount(at[:, r], weights=q, minlength=3)
        table /= table.sum(2, keepdims=True)
        prior = float((p @ weight + 4) / (weight.sum() + 5))
        moved = np.abs(table - model.table).max() + abs(prior - model.prior)
        model = RuleModel(prior, table)
        p = model.posterior(votes)
        if moved < tolerance:
            break
    return model


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the counts, ``p_good`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated 3-word
    windows. ``kept`` is false then, else whether the posterior reaches ``threshold``.
    A null text counts as ''. An empty table gives no rows.
    """
    found = rules()
    names = list(found)
    counted = written(count_columns(docs, ["doc_id"]), "rule_counts").withColumns(found)
    rows = counted.groupBy(*names).count().collect()  # at most 3 ** len(rules) rows
    votes = np.array([[r[k] for k in names] for r in rows], np.int64).reshape(-1, len(names))
    model = estimate(votes, np.array([r["count"] for r in rows], float))
    logs = np.log(model.table)
    z = F.lit(float(np.log(model.prior) - np.log1p(-model.prior)))
    for r, k in enumerate(names):
        odds = logs[r, 1] - logs[r, 0]
        z = z + (F.when(F.col(k) == 0, float(odds[0])).when(F.col(k) == 1, float(odds[1]))
                 .otherwise(float(odds[2])))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (counted.withColumn("p_good", 1 / (1 + F.exp(-z)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
            .select("doc_id", *COUNTS, "p_good", "base_failed", "kept"))
