"""Atomic commits on a shared file system, the base of replaceable tables and exactly-once appends.

Data is written to folders of their own first. A commit is one small JSON file that names
them, put in place by a rename that fails if the name is taken. Readers follow committed
files only, so a run that breaks off leaves folders that nobody reads, and the state
before it stays readable throughout.

The rename is atomic on HDFS and on local disks. On a store without an atomic rename, let one
writer work at a time; readers are safe there too, as a file appears when it is complete.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class Files:
    """The few file operations that commits need, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.root = root

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, name) if name
                                                   else self.root)

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def exists(self) -> bool:
        return self._fs().exists(self._path())

    def names(self) -> list[str]:
        """Names under the root, hidden ones left out; none if there is no root."""
        fs, root = self._fs(), self._path()
        if not fs.exists(root):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(root)
                      if s.getPath().getName()[0] not in "._")

    def age_ms(self, name: str) -> int:
        at = self._fs().getFileStatus(self._path(name)).getModificationTime()
        return self._jvm.System.currentTimeMillis() - at

    def read(self, name: str) -> dict:
        stream = self._fs().open(self._path(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, name: str, value: dict) -> bool:
        """Write ``value`` as file ``name``, complete or not at all; False if it is there."""
        fs, final = self._fs(), self._path(name)
        if fs.exists(final):
            return False
        part = self._path(f".{name}-{uuid.uuid4().hex}")
        out = fs.create(part)
        try:
            out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            out.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(fs.getUri(), self._conf)
        no_options = self._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(part), fs.makeQualified(final), no_options)
            return True
        except Exception:
            fs.delete(part, False)
            if fs.exists(final):  # another writer was first
                return False
            raise

    def make(self) -> None:
        """The root folder itself."""
        self._fs().mkdirs(self._path())

    def move(self, name: str, folder: str) -> None:
        """Move ``name`` into ``folder``, on the same file system, in one step."""
        fs, target = self._fs(), self._jvm.org.apache.hadoop.fs.Path(folder)
        fs.mkdirs(target)
        if not fs.rename(self._path(name), self._jvm.org.apache.hadoop.fs.Path(target, name)):
            raise OSError(f"{os.path.join(self.root, name)} was not moved to {folder}")

    def delete(self, name: str) -> None:
        self._fs().delete(self._path(name), True)


class CommitLog:
    """Numbered states (JSON objects) under ``<root>/_commits``; the last one holds."""

    FOLDER = "_commits"

    def __init__(self, spark: SparkSession, root: str):
        self._files = Files(spark, os.path.join(root, self.FOLDER))

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._files.names() if n.endswith(".json")]

    def state(self, number: int | None = None) -> dict:
        """The last state, or that of a commit; empty before the first."""
        if number is None:
            number = max(self.numbers(), default=0)
        return self._files.read(self._name(number)) if number else {}

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:020d}.json"

    def commit(self, change: Callable[[dict], dict]) -> dict:
        """Put ``change(last state)`` in place as the next state; again if another writer was first."""
        while True:
            number = max(self.numbers(), default=0)
            new = change(self.state(number))
            if self._files.put(self._name(number + 1), new):
                return new

    def forget(self, keep: int) -> None:
        """Delete all but the last ``keep`` states."""
        for number in sorted(self.numbers())[:-keep]:
            self._files.delete(self._name(number))
