"""Shared by the operators that learn from ``labels``: folds, samples, a small regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowtext import let_go, text_slices, utf8
from .wordhash import Words, shingle_sets

#: Shingle hashes, the smallest of a text, that tell texts apart.
SKETCH = 4


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds).cast("int")


def training_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column,
                    per_class: int) -> DataFrame:
    """(text, label) of different texts from at most ``per_class`` labelled rows of each class.

    Rows are chosen by a hash of their id among those where ``usable`` (on doc_id)
    holds; an id with both labels counts as 1. The chosen ids (at most 2 * per_class)
    are broadcast, so no text is shuffled before it is chosen. Texts of one label with
    the same SKETCH smallest 5-word shingle hashes, as copies and most near copies have, count
    once; a line that different texts share does not make them one, nor do two labels.
    """
    one = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & usable)
           .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    chosen = None
    for value in (0, 1):
        part = (one.where(F.col("label") == value)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
        chosen = part if chosen is None else chosen.unionByName(part)
    found = (docs.select("doc_id", "text").where("text is not null")
             .join(F.broadcast(chosen), "doc_id").select("text", "label"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                least = [s[:SKETCH].tobytes() for s in shingle_sets(Words(*utf8(texts)), 5)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(least, pa.binary())],
                                                 names=["text", "label", "sketch"])

    return (found.mapInArrow(sketch, "text string, label int, sketch binary")
            .groupBy("label", "sketch").agg(F.min("text").alias("text")).select("text", "label"))


def logistic_map(x: np.ndarray, y: np.ndarray, mean: np.ndarray, precision: float,
                 steps: int = 50) -> np.ndarray:
    """Logistic regression weights with a normal prior around ``mean``, by Newton steps.

    The last column of ``x`` should be ones; its weight has almost no prior.
    """
    w = mean.astype(float).copy()
    lam = np.full(x.shape[1], precision)
    lam[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + lam * (w - mean)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(lam)
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        w -= step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-7:
            break
    return w
