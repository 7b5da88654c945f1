"""Staging models: clean, cast and deduplicate one raw table each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (month_of, parse_review_count, parse_review_pct, parse_subgenre,
                         present, surrogate_key, try_bigint, year_of)
from ..operators.dedup import asc_first, keep_first

SETLIST_REST = ["artist_mbid", "artist_name", "venue_id", "venue_name", "city_name", "state",
                "country_code", "country_name", "latitude", "longitude", "tour_name"]


def stg_bands(raw_bands: DataFrame) -> DataFrame:
    """One row per band_id (first by name, then the other columns)."""
    first = keep_first(raw_bands, ["band_id"],
                       asc_first("band_name", "country", "genre", "status"))
    return first.select("band_id", "band_name", "country", "genre",
                        parse_subgenre("genre").alias("primary_subgenre"), "status")


def stg_albums(raw_albums: DataFrame, reviewed_only: bool = False) -> DataFrame:
    """Parsed reviews, valid years only, one row per (band, album, year).

    ``reviewed_only=True`` returns the same rows as ``stg_albums(raw).where(
    "review_count > 0")`` but filters before the dedup: the dedup keeps the
    row with the most reviews, so a group's survivor has reviews exactly when
    one of its rows has, and ties are broken among the same rows. Catalyst
    cannot move a filter on a non-key column below the window itself; doing
    it here shrinks the dedup's shuffle and sort for the marts that only
    read reviewed albums.
    """
    parsed = raw_albums.select(
        "band_id", "album_name", "album_type",
        try_bigint("year").alias("year"),
        parse_review_count("reviews").alias("review_count"),
        parse_review_pct("reviews").alias("avg_review_pct"),
    ).where(F.col("year").isNotNull())
    if reviewed_only:
        parsed = parsed.where(F.col("review_count") > 0)
    first = keep_first(parsed, ["band_id", "album_name", "year"],
                       [F.col("review_count").desc_nulls_last(),
                        F.col("avg_review_pct").desc_nulls_last(),
                        F.col("album_type").asc_nulls_first()])
    return first.select(
        surrogate_key("band_id", "album_name", "year").alias("album_id"),
        "band_id", "album_name", "album_type", "year", "review_count", "avg_review_pct")


def stg_setlists(raw_setlists: DataFrame) -> DataFrame:
    """One row per setlist_id (earliest event date), year/month as bigint."""
    first = keep_first(raw_setlists, ["setlist_id"], asc_first("event_date", *SETLIST_REST))
    return first.select(
        "setlist_id", "artist_mbid", "artist_name", "event_date",
        year_of("event_date").alias("event_year"), month_of("event_date").alias("event_month"),
        "venue_id", "venue_name", "city_name", "state", "country_code", "country_name",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "tour_name")


def stg_songs(raw_songs: DataFrame) -> DataFrame:
    """One row per (setlist, song, set); tapes and nameless songs dropped.

    The live row is preferred over a tape of the same song (decision D3); the
    tape filter stays above the dedup, as in the model.
    """
    first = keep_first(raw_songs, ["setlist_id", "song_name", "set_name"],
                       asc_first("is_tape", "encore", "is_cover", "cover_artist_name"))
    kept = first.where(~F.coalesce(F.col("is_tape"), F.lit(False)) & present("song_name"))
    return kept.select(
        surrogate_key("setlist_id", "song_name", F.coalesce(F.col("set_name"), F.lit("")),
                      "encore").alias("song_id"),
        "setlist_id", "song_name", "set_name",
        F.col("encore").cast("bigint").alias("encore"),
        F.coalesce(F.col("is_cover"), F.lit(False)).alias("is_cover"),
        "cover_artist_name",
        F.coalesce(F.col("is_tape"), F.lit(False)).alias("is_tape"))


def stg_band_mapping(raw_mapping: DataFrame) -> DataFrame:
    return raw_mapping.select(
        F.col("ma_band_id").cast("string").alias("ma_band_id"),
        "ma_band_name", "sfm_mbid", "sfm_artist_name", "match_type")


def stg_labels(raw_labels: DataFrame) -> DataFrame:
    return raw_labels.where(present("label_id")).select(
        "label_id", "band_id", "label_name", "specialization", "status", "country")


#: Models that work setlist by setlist or band by band: their raw rows may be partitioned by that key.
BY_KEY = {"stg_bands": stg_bands, "stg_albums": stg_albums, "stg_setlists": stg_setlists,
          "stg_songs": stg_songs}


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All six staging models from the raw tables (lazy)."""
    return {
        "stg_bands": stg_bands(raw["bands"]),
        "stg_albums": stg_albums(raw["albums"]),
        "stg_setlists": stg_setlists(raw["setlists"]),
        "stg_songs": stg_songs(raw["songs"]),
        "stg_band_mapping": stg_band_mapping(raw["band_mapping"]),
        "stg_labels": stg_labels(raw["labels"]),
    }
