"""Helpers for Arrow batches of texts inside Spark tasks.

Operators that work on whole texts read Arrow record batches, cut them into
slices of bounded bytes (one very long text is a slice of its own) and work on
the UTF-8 bytes with numpy.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa

#: Bytes of text that one step of an operator holds at once.
SLICE_BYTES = 4 << 20


def text_slices(batch: pa.RecordBatch, column: str,
                max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, texts) of at most ``max_bytes`` of text each, nulls as ''."""
    texts = pa.array(batch.column(column)).cast(pa.large_string()).fill_null("")
    offs = offsets(texts)
    i, n = 0, len(texts)
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield batch.slice(i, j - i), texts.slice(i, j - i)
        i = j


def offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets (length + 1) of a large_string array."""
    buf = texts.buffers()[1]
    if buf is None:
        return np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(buf, np.int64)[texts.offset:texts.offset + len(texts) + 1]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end, and the offset of each text in them."""
    offs = offsets(texts)
    data = texts.buffers()[2]
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept in this Python worker for its next tasks of the same key.

    Workers outlive a job. One object is kept at a time, so what an earlier operator needed
    (a vocabulary, a cache) does not stay beside what the next one needs.
    """
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Free what ``kept`` holds, at the start of a task that needs none of it."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


@contextmanager
def small_batches(spark, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows in the jobs of the block, for rows of many KiB.

    Spark counts a batch in rows (10,000 by default), on either side of the worker's pipe.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(old)) if int(old) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def find_on_workers(spark) -> None:
    """Put this package's folder on the import path of Python workers.

    Covers sessions whose executors see the same files as the driver but run elsewhere
    (a notebook, a test); on other clusters ship the package with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
