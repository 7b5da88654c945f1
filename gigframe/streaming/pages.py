"""Incremental ingest of landed API pages with Structured Streaming.

New page files (one JSON page per line) are picked up by a file-source
stream; each micro-batch flattens all its pages into setlist and song records.
Nothing depends on which pages share a batch: a paging rule, if one is wanted,
is applied to the landed pages as a whole (``sources.pages.select_pages``).

Writes are idempotent per batch: each batch overwrites its own
``batch_id=<n>`` folder, so a batch replayed after a failure replaces, not
duplicates, its output. The file log and batch offsets live in the
checkpoint folder; a re-run reads only files it has not committed.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.commits import Files
from ..sources.landing import write_pages
from ..sources.pages import flatten_setlists, flatten_songs
from ..sources.schemas import API_PAGE


def _batch_path(out_dir: str, table: str, batch_id: int) -> str:
    return os.path.join(out_dir, table, f"batch_id={batch_id}")


def run_page_ingest(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint: str,
                    files_per_batch: int | None = None) -> None:
    """Flatten every page file not seen before into ``out_dir``; stop when done.

    A line that is not a page stops the run; its batch is not committed.
    """
    reader = spark.readStream.schema(API_PAGE).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.json(pages_dir)

    def flatten_batch(batch: DataFrame, batch_id: int) -> None:
        setlists, songs = flatten_setlists(batch), flatten_songs(batch)
        setlists.write.mode("overwrite").parquet(_batch_path(out_dir, "setlists", batch_id))
        songs.write.mode("overwrite").parquet(_batch_path(out_dir, "songs", batch_id))

    q = (pages.writeStream.foreachBatch(flatten_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_ingested(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """All batches of one output table (the batch folder is a partition column)."""
    return spark.read.parquet(os.path.join(out_dir, table)).drop("batch_id")


def split_drops(pages: DataFrame, drops: int = 2) -> list[DataFrame]:
    """Split pages into landing drops by artist (all pages of an artist together)."""
    return [pages.where(_drop(drops) == i) for i in range(drops)]


def _drop(drops: int) -> Column:
    return F.pmod(F.xxhash64("mbid"), F.lit(drops))


def write_drops(pages: DataFrame, path: str, drops: int = 2) -> list[str]:
    """The drops of ``split_drops``, written in one pass: a folder under ``path`` each, in order."""
    write_pages(pages.withColumn("drop", _drop(drops)), path, by="drop")
    return [os.path.join(path, f"drop={i}") for i in range(drops)]


def land_drop(spark: SparkSession, drop: str, landing: str) -> None:
    """Move a written drop into the landing folder in one step; one without pages has no folder."""
    folder = Files(spark, os.path.dirname(drop))
    if os.path.basename(drop) in folder.names():
        folder.move(os.path.basename(drop), landing)
    else:
        Files(spark, os.path.join(landing, os.path.basename(drop))).make()
