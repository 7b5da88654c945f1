"""Ingest selection: which bands to look up, how to map them, what is new.

The HTTP client of the original ingester is out of scope: search hits and
API pages arrive as landed tables/files, and these functions make the same
choices over them as Spark jobs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import counter_review_count, present
from ..operators.dedup import asc_first, keep_first
from ..operators.joins import fixed_broadcast
from ..sources.csv import read_raw_table
from ..sources.ledger import Ledger, content_id
from ..sources.pages import flatten_setlists, flatten_songs, select_pages
from ..sources.schemas import RAW_TABLES
from ..sources.sinks import write_append

BAND_COLUMNS = ["band_id", "band_name", "country", "genre", "status"]


def first_bands(raw_bands: DataFrame) -> DataFrame:
    """Raw band rows, first per band_id (by name, then the other columns)."""
    return keep_first(raw_bands.select(*BAND_COLUMNS), ["band_id"],
                      asc_first("band_name", "country", "genre", "status"))


def top_bands_by_reviews(raw_albums: DataFrame, raw_bands: DataFrame, n: int = 50) -> DataFrame:
    """The n bands with the most reviews (raw album rows, bad text ignored).

    Counts are summed per band with map-side partial sums. The n ids (a
    fixed-size list) are broadcast twice: to keep only those bands' rows
    before the keep-first dedup (it is per band_id, so that is the same
    result as deduplicating all bands first), and to attach the totals.
    """
    counts = (raw_albums.select("band_id", counter_review_count("reviews").alias("c"))
              .where(F.col("c").isNotNull())
              .groupBy("band_id").agg(F.sum("c").alias("total_reviews")))
    top = counts.orderBy(F.col("total_reviews").desc(), F.col("band_id").asc()).limit(n)
    rows = raw_bands.join(fixed_broadcast(top.select("band_id")), "band_id", "left_semi")
    return first_bands(rows).join(fixed_broadcast(top), "band_id")


def match_artists(bands: DataFrame, candidates: DataFrame) -> DataFrame:
    """Band -> artist mapping from search hits.

    Per band: the best-ranked hit whose name equals the band name ignoring
    case, else the best-ranked hit ('fuzzy'); a hit without a rank comes last.
    Bands without hits get no row; a chosen hit without an mbid is dropped (it
    would match every setlist without one).

    The hits are read and shuffled once: they are reduced map-side to one row per
    (band, lower-cased name), and a band's best hits, of its own name and of any,
    are taken from those rows. A band with a third of all hits costs one row per
    name and map task.
    """
    hit = F.struct(F.col("rank").isNull().alias("unranked"), F.col("rank"),
                   F.col("name").alias("artist_name"), F.col("mbid"))
    by_name = (candidates.groupBy("band_id", F.lower("name").alias("lname"))
               .agg(F.min(hit).alias("hit")))
    b = bands.select("band_id", "band_name")
    own = F.col("lname") == F.lower("band_name")
    chosen = (by_name.join(b, "band_id").groupBy("band_id", "band_name")
              .agg(F.min(F.when(own, F.col("hit"))).alias("exact_hit"),
                   F.min("hit").alias("any_hit"))
              .select("band_id", "band_name", F.col("exact_hit").isNotNull().alias("exact"),
                      F.coalesce("exact_hit", "any_hit").alias("hit")))
    return (chosen.where(present("hit.mbid"))
            .select(F.col("band_id").alias("ma_band_id"), F.col("band_name").alias("ma_band_name"),
                    F.col("hit.mbid").alias("sfm_mbid"),
                    F.col("hit.artist_name").alias("sfm_artist_name"),
                    F.when(F.col("exact"), F.lit("exact")).otherwise(F.lit("fuzzy"))
                     .alias("match_type")))


def unprocessed(bands: DataFrame, processed_ids: DataFrame) -> DataFrame:
    """Bands whose id is not in the processed-id table (anti join)."""
    return bands.join(processed_ids.select(F.col("band_id")).distinct(), "band_id", "left_anti")


def mark_processed(done: DataFrame, path: str) -> None:
    """Add band ids to the processed table at ``path``; ids already there stay once.

    ``done`` has band_id and found (boolean): a band that the lookup did not find is
    recorded too, so it is not looked up for ever. Write it last, after the records.
    """
    spark = done.sparkSession
    new = (done.select(F.col("band_id").cast("string").alias("band_id"), "found")
           .groupBy("band_id").agg(F.max("found").alias("found")))
    new.join(read_processed(spark, path), "band_id", "left_anti").write.mode("append").parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """(band_id, found) recorded so far; empty before the first run."""
    schema = "band_id string, found boolean"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ingest_pages(pages: DataFrame, max_pages: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Landed pages -> (setlist records, song records) after the paging rule."""
    kept = select_pages(pages, max_pages)
    return flatten_setlists(kept), flatten_songs(kept)


def append_landed(setlists: DataFrame, songs: DataFrame, landing_dir: str,
                  mapping: DataFrame | None = None, batch_id: str | None = None) -> bool:
    """Append flattened records to the landed CSV tables the loader reads, exactly once.

    All tables of a run become visible together, when the run's id enters the folder's
    ledger. A run that breaks off shows nothing, and one that is repeated (the same
    ``batch_id``, or the same rows if none is given) adds nothing. Of the mapping, only rows
    of bands that have none yet are appended. Returns whether the run was new.
    """
    spark = setlists.sparkSession
    name = {t: RAW_TABLES[t].filename for t in ("setlists", "songs", "band_mapping")}
    tables = {name["setlists"]: setlists, name["songs"]: songs}
    if mapping is not None:
        tables[name["band_mapping"]] = mapping
    ledger = Ledger(spark, landing_dir)
    batch_id = batch_id or content_id(tables)
    if batch_id in ledger.batches():
        return False
    if mapping is not None:
        try:
            there = read_raw_table(spark, RAW_TABLES["band_mapping"], landing_dir)
            mapping = mapping.join(
                there.select(F.col("ma_band_id").cast(mapping.schema["ma_band_id"].dataType)
                             .alias("ma_band_id")).distinct(), "ma_band_id", "left_anti"
            ).select(mapping.columns)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        # One row per band, also within the new rows.
        tables[name["band_mapping"]] = keep_first(mapping, ["ma_band_id"],
                                                  asc_first("match_type", "sfm_mbid"))
    return ledger.append(batch_id, tables, lambda df, path: write_append(df, path, "csv"))
