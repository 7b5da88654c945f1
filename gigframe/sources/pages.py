"""Landed API pages (nested JSON) -> flat setlist and song records.

One JSON document per line, each an API page for one artist::

    {"mbid": ..., "page": 1, "itemsPerPage": 20, "total": 57,
     "setlist": [{"id": ..., "eventDate": "23-08-2019", "artist": {...},
                  "venue": {"city": {"coords": {...}, "country": {...}}},
                  "tour": {...}, "sets": {"set": [{"song": [...]}]}}]}

The files are read with a fixed schema (no inference pass) and stay
splittable: one page per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_event_date
from ..session import scratch_path
from .schemas import API_PAGE


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages; a line that is not a page stops the read instead of vanishing."""
    return spark.read.schema(API_PAGE).option("mode", "FAILFAST").json(path)


def page_limits(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """(mbid, end_page) of the artists with pages that the paging loop would not fetch.

    The loop stops at the first empty page, after the page where
    page * itemsPerPage reaches total, and after ``max_pages`` if that is asked for.
    Only artists with a landed page at or past their end are returned.
    """
    big = F.lit(2 ** 31 - 1)
    page = F.col("page")
    empty = F.coalesce(F.size("setlist"), F.lit(0)) == 0
    stop = (page * F.coalesce(F.col("itemsPerPage"), F.lit(20))
            >= F.coalesce(F.col("total"), F.lit(0)))
    limits = pages.where(page >= 1).groupBy("mbid").agg(
        F.least(F.coalesce(F.min(F.when(empty, page)), big),
                F.coalesce(F.min(F.when(stop, page + 1)), big),
                F.lit(max_pages + 1) if max_pages is not None else big).alias("end_page"),
        F.max(page).alias("last_page"))
    return limits.where(F.col("last_page") >= F.col("end_page")).select("mbid", "end_page")


def select_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Keep the pages the paging loop would have fetched, per artist.

    Landed pages are data: a missing page drops nothing (``page_gaps`` reports it),
    and no cap holds unless asked for. A null artist is an artist like another; a page
    without a number is kept. The limits are one slim row per artist that has any (most
    have none). They are written first: their size is known when the join is planned, so the
    wide pages stay where they are unless that table is large.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "page-limits")
    found = page_limits(pages, max_pages).select(F.col("mbid").alias("_mbid"), "end_page")
    found.write.parquet(path)
    limits = spark.read.schema(found.schema).parquet(path)
    return pages.join(limits, pages["mbid"].eqNullSafe(limits["_mbid"])
                      & (pages["page"] >= limits["end_page"]), "left_anti")


def page_gaps(pages: DataFrame) -> DataFrame:
    """Artists whose landed pages have gaps: (mbid, pages, last_page, missing)."""
    per = (pages.where(F.col("page") >= 1).select("mbid", "page").distinct()
           .groupBy("mbid").agg(F.count("*").alias("pages"), F.max("page").alias("last_page")))
    return (per.withColumn("missing", F.col("last_page") - F.col("pages"))
            .where(F.col("missing") > 0))


def _setlists(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("setlist").alias("s"))


def flatten_setlists(pages: DataFrame) -> DataFrame:
    """One record per setlist; missing text fields become '', coordinates stay NULL."""
    s = _setlists(pages)
    e = lambda path: F.coalesce(F.col(f"s.{path}"), F.lit(""))
    return s.select(
        e("id").alias("setlist_id"),
        e("artist.mbid").alias("artist_mbid"),
        e("artist.name").alias("artist_name"),
        parse_event_date(F.col("s.eventDate")).alias("event_date"),
        e("venue.id").alias("venue_id"),
        e("venue.name").alias("venue_name"),
        e("venue.city.name").alias("city_name"),
        e("venue.city.state").alias("state"),
        e("venue.city.country.code").alias("country_code"),
        e("venue.city.country.name").alias("country_name"),
        F.col("s.venue.city.coords.lat").alias("latitude"),
        F.col("s.venue.city.coords.long").alias("longitude"),
        e("tour.name").alias("tour_name"),
    )


def flatten_songs(pages: DataFrame) -> DataFrame:
    """One record per song; set name and encore carried down from the set.

    A setlist without sets yields no songs. ``cover`` is read as a map, so an
    empty object is "no cover", as in the API client.
    """
    sets = (_setlists(pages)
            .select(F.coalesce(F.col("s.id"), F.lit("")).alias("setlist_id"),
                    F.explode("s.sets.set").alias("st")))
    songs = sets.select("setlist_id", "st", F.explode("st.song").alias("sg"))
    cover = F.col("sg.cover")
    has_cover = F.coalesce(F.size(cover) > 0, F.lit(False))
    return songs.select(
        "setlist_id",
        F.coalesce(F.col("sg.name"), F.lit("")).alias("song_name"),
        F.coalesce(F.col("st.name"), F.lit("")).alias("set_name"),
        F.coalesce(F.col("st.encore"), F.lit(0)).cast("bigint").alias("encore"),
        has_cover.alias("is_cover"),
        F.when(has_cover, F.coalesce(F.try_element_at(cover, F.lit("name")), F.lit("")))
         .otherwise(F.lit("")).alias("cover_artist_name"),
        F.coalesce(F.col("sg.tape"), F.lit(False)).alias("is_tape"),
    )
