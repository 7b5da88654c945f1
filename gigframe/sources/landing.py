"""Write raw setlists and songs as landed API pages (the lander's side).

Used to produce page files from tables we hold, e.g. to replay an ingest.
Pages are numbered densely per artist without sorting a large artist's
setlists in one task: its rows are spread over hash buckets (as many as its
size needs), numbered per bucket, and offset by the sizes of the earlier
buckets (a small table).

The page format nests a setlist's sets and songs in one record, so building
a page collects rows: at most ``items_per_page`` setlists per page, each
with its own songs. That is the format's bound (an API page), not a group
of the data at large; nothing else in the library collects rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import present
from ..operators.joins import fixed_broadcast
from .csv import WRITE_OPTIONS
from .schemas import RAW_TABLES

ITEMS_PER_PAGE = 20
ROWS_PER_BUCKET = 1_000_000
#: Landed text is compressed. As such a file has one reader, a file has this many lines at most.
PAGES_PER_FILE = 10_000
LINES_PER_FILE = 1_000_000


def dense_positions(df: DataFrame, group: str, key: str,
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``pos`` = 1..n within each ``group`` and ``group_total`` = n.

    Skew-safe at any size: a group is split into ceil(n / rows_per_bucket)
    hash buckets, each numbered by its own task, and a bucket's positions are
    offset by the sizes of the group's earlier buckets. The rows are shuffled once:
    the groups of more than one bucket, at most rows / rows_per_bucket, and their buckets'
    sizes are broadcast. A null group is a group like another.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_cnt"))
    hot = fixed_broadcast(
        counts.where(F.col("_cnt") > rows_per_bucket)
              .select(F.col(group).alias("_hot"),
                      F.ceil(F.col("_cnt") / F.lit(rows_per_bucket)).alias("_nb")))
    b = (df.join(hot, df[group].eqNullSafe(hot["_hot"]), "left")
           .withColumn("_b", F.pmod(F.xxhash64(F.col(key)), F.coalesce(F.col("_nb"), F.lit(1)))))
    sizes = (b.where(F.col("_nb").isNotNull()).groupBy(group, "_b")
             .agg(F.count(F.lit(1)).alias("_cnt")))
    bucket = Window.partitionBy(group, "_b")
    rn = b.drop("_nb", "_hot").withColumns({
        "_rn": F.row_number().over(bucket.orderBy(F.col(key))),
        "_size": F.count(F.lit(1)).over(bucket)})
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(group).alias("_group"), F.col("_b").alias("_bucket"),
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(group)).alias("_total"))
    same = rn[group].eqNullSafe(offsets["_group"]) & (rn["_b"] == offsets["_bucket"])
    return (rn.join(fixed_broadcast(offsets), same, "left")
              .withColumn("group_total", F.coalesce("_total", "_size"))
              .withColumn("pos", F.coalesce("_off", F.lit(0)) + F.col("_rn"))
              .drop("_b", "_rn", "_size", "_off", "_total", "_group", "_bucket"))


def build_pages(raw_setlists: DataFrame, raw_songs: DataFrame,
                items_per_page: int = ITEMS_PER_PAGE) -> DataFrame:
    """API pages (one row per artist page) from flat setlists and songs.

    Songs without a setlist id belong to no setlist, so to no page. Setlists are numbered
    before they get their songs. Songs are shuffled once, flat and by setlist; both steps of
    nesting and the join work where they are then.
    """
    song = F.struct(
        F.col("song_name").alias("name"),
        F.col("is_tape").alias("tape"),
        F.when(F.col("is_cover"), F.create_map(F.lit("name"), F.col("cover_artist_name")))
         .otherwise(F.create_map().cast("map<string,string>")).alias("cover"))
    sets = (raw_songs.where(present("setlist_id")).repartition("setlist_id")
            .groupBy("setlist_id", "set_name", "encore")
            .agg(F.collect_list(song).alias("song"))
            .groupBy("setlist_id")
            .agg(F.collect_list(F.struct(F.col("set_name").alias("name"),
                                         F.col("encore").cast("int").alias("encore"),
                                         "song")).alias("set")))
    setlist = F.struct(
        F.col("setlist_id").alias("id"),
        F.date_format("event_date", "dd-MM-yyyy").alias("eventDate"),
        F.struct(F.col("artist_mbid").alias("mbid"), F.col("artist_name").alias("name")).alias("artist"),
        F.struct(F.col("venue_id").alias("id"), F.col("venue_name").alias("name"),
                 F.struct(F.col("city_name").alias("name"), F.col("state").alias("state"),
                          F.struct(F.col("latitude").alias("lat"),
                                   F.col("longitude").alias("long")).alias("coords"),
                          F.struct(F.col("country_code").alias("code"),
                                   F.col("country_name").alias("name")).alias("country"))
                  .alias("city")).alias("venue"),
        F.when(F.col("tour_name") != "", F.struct(F.col("tour_name").alias("name"))).alias("tour"),
        F.when(F.col("set").isNotNull(), F.struct(F.col("set").alias("set"))).alias("sets"),
    )
    # Uniquely identify each row (the same setlist may be landed twice).
    keyed = raw_setlists.withColumn(
        "_key", F.concat_ws("#", "setlist_id", F.col("event_date").cast("string"), "venue_id"))
    numbered = dense_positions(keyed, "artist_mbid", "_key").drop("_key")
    return (numbered.join(sets, "setlist_id", "left")
            .withColumn("page", ((F.col("pos") - 1) / items_per_page).cast("int") + 1)
            .groupBy(F.col("artist_mbid").alias("mbid"), "page")
            .agg(F.max("group_total").cast("int").alias("total"),
                 F.collect_list(setlist).alias("setlist"))
            .select("mbid", F.lit(items_per_page).alias("itemsPerPage"), "page", "total",
                    "setlist"))


def write_pages(pages: DataFrame, path: str, by: str | None = None) -> str:
    """One JSON page per line, compressed, in files of bounded size; a folder ``<by>=<value>``
    per value of the column ``by``, which no page has then."""
    columns = [c for c in pages.columns if c != by]
    lines = pages.select(F.to_json(F.struct(*columns)).alias("value"), *([by] if by else []))
    writer = (lines.write.mode("overwrite").option("compression", "gzip")
              .option("maxRecordsPerFile", PAGES_PER_FILE))
    (writer.partitionBy(by) if by else writer).text(path)
    return path


def write_landing_csv(raw: dict[str, DataFrame], landing_dir: str,
                      extra_columns: bool = True, only: list[str] | None = None,
                      parallel: int = 4) -> str:
    """Write raw tables as the landed CSV files the loader reads.

    Header-named tables get their original headers (with blanks) and, if
    ``extra_columns``, a column the loader must ignore. The files are compressed, fast rather
    than well: they are read once or twice. Up to ``parallel`` tables are written at once.
    """
    from concurrent.futures import ThreadPoolExecutor

    def write(name: str) -> None:
        t, df = RAW_TABLES[name], raw[name]
        if t.all_string:
            df = df.select(*[F.col(new).alias(old.replace("_", " "))
                             for old, new in t.renames.items()])
            if extra_columns:
                df = df.withColumn("Themes", F.lit("unused"))
        (df.write.mode("overwrite").options(**WRITE_OPTIONS).option("compression", "gzip")
         .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", LINES_PER_FILE)
         .csv(os.path.join(landing_dir, t.filename)))

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(write, [n for n in RAW_TABLES if only is None or n in only]))
    return landing_dir
