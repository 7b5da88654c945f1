"""Exactly-once appends: batches of landed records, read only if the ledger has them.

A batch is written to a folder of its own, ``<root>/_batches/<batch>-<attempt>/<table>``,
hidden from readers of the tables' own folders. Then one file in ``<root>/_ledger``, named
by the batch's id, makes all its tables visible together (``sources.commits``). A batch
whose id is there is not written again; of two writers of one batch, the first to commit
counts. A run that breaks off leaves a folder that nobody reads, until ``sweep``.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import Files


def content_id(tables: dict[str, DataFrame]) -> str:
    """A batch id from the rows of its tables, whatever their order: equal batches share it."""
    parts = []
    for name, df in sorted(tables.items()):
        row = F.xxhash64(*df.columns)
        again = F.xxhash64(F.lit(1), *df.columns)
        n, a, b, c = df.agg(F.count(F.lit(1)), F.bit_xor(row), F.bit_xor(again),
                            F.sum(row.cast("decimal(20,0)"))).first()
        parts.append(f"{name}:{n}:{a}:{b}:{c}")
    return hashlib.sha256("|".join(parts).encode()).hexdigest()[:32]


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._entries = Files(spark, os.path.join(root, "_ledger"))
        self._batches = Files(spark, os.path.join(root, "_batches"))

    @staticmethod
    def _name(batch_id: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._=-]*", batch_id):
            raise ValueError(f"a batch id of letters, digits and ._=- is needed: {batch_id!r}")
        return f"{batch_id}.json"

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return [n[:-5] for n in self._entries.names() if n.endswith(".json")]

    def append(self, batch_id: str, tables: dict[str, DataFrame],
               save: Callable[[DataFrame, str], None]) -> bool:
        """Write and commit a batch; False if it was there already.

        ``save(df, path)`` writes one table.
        """
        entry = self._name(batch_id)
        if entry in self._entries.names():
            return False
        folder = f"{batch_id}-{uuid.uuid4().hex[:8]}"
        for name, df in tables.items():
            save(df, os.path.join(self.root, "_batches", folder, name))
        return self._entries.put(entry, {"folder": folder, "tables": sorted(tables)})

    def folders(self, table: str) -> list[str]:
        """The folders of a table in all committed batches."""
        entries = [self._entries.read(n) for n in self._entries.names() if n.endswith(".json")]
        return [os.path.join(self.root, "_batches", e["folder"], table)
                for e in entries if table in e["tables"]]

    def sweep(self, older_than_hours: float = 24) -> list[str]:
        """Delete folders of that age that no committed batch names, and return them."""
        kept = {self._entries.read(n)["folder"] for n in self._entries.names()}
        gone = [n for n in self._batches.names()
                if n not in kept and self._batches.age_ms(n) >= older_than_hours * 3_600_000]
        for name in gone:
            self._batches.delete(name)
        return gone
