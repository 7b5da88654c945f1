"""Marts: the concert fact, two dimensions and eleven aggregates.

Each mart is a pure function of staging DataFrames (or of the fact). Joins
are written against pre-aggregated sides, so no join multiplies rows before
an aggregate, and aggregates shuffle partial results, not raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_abbrev, present, productivity_bucket, touring_bucket
from ..operators.shares import parent_total, pct, ratio, with_grand_total

MEDIAN_ACCURACY = 10000


def _n() -> F.Column:
    return F.count(F.lit(1))


def _distinct(col: str, exact: bool) -> F.Column:
    """count(distinct col); ``exact=False`` trades exactness for a fixed-size
    HyperLogLog++ sketch (relative error ~1%) per group."""
    return F.count_distinct(col) if exact else F.approx_count_distinct(col, 0.01)


def _approx_median(col: str) -> F.Column:
    """An actual element near the middle, from a mergeable quantile sketch."""
    return F.percentile_approx(col, 0.5, MEDIAN_ACCURACY)


def band_albums(stg_albums: DataFrame) -> DataFrame:
    """Album figures per band: of all its albums, and of those with reviews.

    Five marts need them. Where the albums would be read and shuffled by each of these, the
    figures are written once and passed as ``albums``. ``scored_albums`` have reviews and a score.
    """
    reviewed = F.col("review_count") > 0
    return stg_albums.groupBy("band_id").agg(
        _n().alias("total_albums"), F.avg("avg_review_pct").alias("avg_review_score"),
        F.sum("review_count").alias("total_reviews"),
        F.count_if(reviewed).alias("reviewed_albums"),
        F.count(F.when(reviewed, F.col("avg_review_pct"))).alias("scored_albums"),
        F.avg(F.when(reviewed, F.col("avg_review_pct"))).alias("reviewed_score"),
        F.sum(F.when(reviewed, F.col("review_count"))).alias("reviewed_reviews"),
        F.min("year").alias("debut_year"))


def fct_concerts(stg_setlists: DataFrame, stg_band_mapping: DataFrame, stg_bands: DataFrame,
                 stg_songs: DataFrame, stg_albums: DataFrame,
                 albums: DataFrame | None = None) -> DataFrame:
    """One row per (setlist, mapped band) with song count and album reviews.

    Songs and albums are reduced per key before joining. The band-level
    tables (mapping, band, album figures: one row per band) are joined to
    each other first, so the large setlist side meets them in one join on
    the artist id; that side is broadcast when AQE measures it small, else
    the setlists are shuffled once and AQE splits a hot artist's partition.
    The left join to the song counts needs no exchange of its own: both
    sides are already hash-partitioned by setlist_id (by the setlist dedup
    and by the song aggregate). ``albums``: the ``band_albums``, if they are at hand.
    """
    songs_agg = stg_songs.groupBy("setlist_id").agg(_n().alias("song_count"))
    if albums is not None:
        album_stats = albums.where(F.col("reviewed_albums") > 0).select(
            F.col("band_id").alias("ab_band_id"), F.col("reviewed_score").alias("avg_review_score"),
            F.col("reviewed_reviews").alias("review_count"))
    else:
        album_stats = (stg_albums.where(F.col("review_count") > 0)
                       .groupBy(F.col("band_id").alias("ab_band_id"))
                       .agg(F.avg("avg_review_pct").alias("avg_review_score"),
                            F.sum("review_count").alias("review_count")))
    mapping = stg_band_mapping.select("sfm_mbid", F.col("ma_band_id").alias("m_band_id"))
    bands = stg_bands.select("band_id", "primary_subgenre")
    band_level = (mapping.join(bands, F.col("m_band_id") == F.col("band_id"))
                  .join(album_stats, F.col("band_id") == F.col("ab_band_id"), "left")
                  .drop("m_band_id", "ab_band_id"))
    s = stg_setlists.join(songs_agg, "setlist_id", "left")
    joined = s.join(band_level, s.artist_mbid == band_level.sfm_mbid)
    return joined.select(
        F.col("setlist_id").alias("concert_id"),
        F.col("band_id").alias("ma_band_id"),
        "artist_name", "primary_subgenre", "event_date", "event_year", "event_month",
        "venue_name", "city_name", "country_code", "country_name", "latitude", "longitude",
        "tour_name",
        F.coalesce(F.col("song_count"), F.lit(0).cast("bigint")).alias("song_count"),
        "avg_review_score", "review_count")


def dim_bands(stg_bands: DataFrame, stg_band_mapping: DataFrame, stg_albums: DataFrame,
              fct: DataFrame, albums: DataFrame | None = None) -> DataFrame:
    """Every staged band with mapping, album and concert figures (left joins).

    Unlike the fact, album figures here include albums without reviews. ``albums``: the
    ``band_albums``, if they are at hand.
    """
    if albums is not None:
        album_stats = albums.select(F.col("band_id").alias("a_band_id"), "total_albums",
                                    "avg_review_score", "total_reviews")
    else:
        album_stats = stg_albums.groupBy(F.col("band_id").alias("a_band_id")).agg(
            _n().alias("total_albums"), F.avg("avg_review_pct").alias("avg_review_score"),
            F.sum("review_count").alias("total_reviews"))
    concert_stats = fct.groupBy(F.col("ma_band_id").alias("c_band_id")).agg(
        _n().alias("total_concerts"))
    mapping = stg_band_mapping.select(F.col("ma_band_id").alias("m_band_id"), "sfm_mbid")
    b = stg_bands
    joined = (b.join(mapping, b.band_id == mapping.m_band_id, "left")
               .join(album_stats, b.band_id == album_stats.a_band_id, "left")
               .join(concert_stats, b.band_id == concert_stats.c_band_id, "left"))
    zero = F.lit(0).cast("bigint")
    return joined.select(
        F.col("band_id").alias("ma_band_id"), "band_name", "country", "primary_subgenre",
        F.col("genre").alias("full_genre"), "status", "sfm_mbid",
        F.col("sfm_mbid").isNotNull().alias("has_setlist_data"),
        F.coalesce("total_albums", zero).alias("total_albums"),
        "avg_review_score",
        F.coalesce("total_reviews", zero).alias("total_reviews"),
        F.coalesce("total_concerts", zero).alias("total_concerts"))


def dim_venues(stg_setlists: DataFrame) -> DataFrame:
    """One row per venue; descriptive text by max (deterministic any-value)."""
    return (stg_setlists.where(present("venue_id"))
            .groupBy("venue_id")
            .agg(F.max("venue_name").alias("venue_name"), F.max("city_name").alias("city_name"),
                 F.max("state").alias("state"), F.max("country_code").alias("country_code"),
                 F.max("country_name").alias("country_name"),
                 F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"),
                 _n().alias("concert_count")))


def agg_concerts_by_country(fct: DataFrame) -> DataFrame:
    return (fct.where(present("country_code"))
            .groupBy("country_code", "country_name")
            .agg(_n().alias("concert_count"), F.avg("latitude").alias("avg_latitude"),
                 F.avg("longitude").alias("avg_longitude")))


def agg_concerts_over_time(fct: DataFrame) -> DataFrame:
    return fct.groupBy("event_year", "event_month").agg(_n().alias("concert_count"))


def agg_country_genre_affinity(stg_bands: DataFrame, min_country_bands: int = 50,
                               min_band_count: int = 3) -> DataFrame:
    """Location quotient of each subgenre in each country.

    LQ = (country's share of the genre) / (genre's share of all bands). The
    totals are windows over the aggregated (country, genre) rows, and the
    grand total is a broadcast one-row aggregate.
    """
    cg = (stg_bands.where(present("primary_subgenre") & present("country"))
          .groupBy("country", "primary_subgenre").agg(_n().alias("band_count")))
    cg = (cg.withColumn("country_total_bands", parent_total("band_count", ["country"]))
            .withColumn("genre_total", parent_total("band_count", ["primary_subgenre"])))
    cg = with_grand_total(cg, "band_count", "grand_total")
    lq = ratio("band_count", "country_total_bands") / ratio("genre_total", "grand_total")
    return (cg.where((F.col("country_total_bands") >= min_country_bands)
                     & (F.col("band_count") >= min_band_count))
              .select("country", "primary_subgenre", "band_count", "country_total_bands",
                      pct("band_count", "country_total_bands", 1).alias("genre_pct_in_country"),
                      F.round(lq, 2).alias("location_quotient")))


def agg_festival_seasonality(fct: DataFrame, exact_distinct: bool = True) -> DataFrame:
    return (fct.groupBy("event_month")
            .agg(_n().alias("concert_count"),
                 _distinct("ma_band_id", exact_distinct).alias("unique_bands"),
                 _distinct("country_code", exact_distinct).alias("unique_countries"))
            .select("event_month", month_abbrev("event_month").alias("month_name"),
                    "concert_count", "unique_bands", "unique_countries"))


def agg_genre_lifecycle(stg_albums: DataFrame, stg_bands: DataFrame, first_year: int = 1970,
                        last_year: int = 2024, albums: DataFrame | None = None) -> DataFrame:
    """New bands per (debut year, subgenre); debut = first album year. ``albums``: the
    ``band_albums``, if they are at hand."""
    if albums is not None:
        debut = albums.select("band_id", "debut_year")
    else:
        debut = stg_albums.groupBy("band_id").agg(F.min("year").alias("debut_year"))
    bands = stg_bands.where(present("primary_subgenre")).select("band_id", "primary_subgenre")
    return (bands.join(debut, "band_id")
            .where(F.col("debut_year").between(first_year, last_year))
            .groupBy("debut_year", "primary_subgenre").agg(_n().alias("new_bands")))


def agg_genre_review_distribution(stg_albums: DataFrame, stg_bands: DataFrame,
                                  min_albums: int = 50,
                                  albums: DataFrame | None = None) -> DataFrame:
    """Review scores of reviewed albums, for subgenres with >= ``min_albums``.

    One lazy plan: the per-genre counts come from the same joined rows (the exchanges
    are reused), and AQE broadcasts them if their measured size is small. With ``albums``, the
    ``band_albums``, the counts are sums over bands.
    """
    scored = (stg_albums.where((F.col("review_count") > 0) & F.col("avg_review_pct").isNotNull())
              .select("band_id", "avg_review_pct"))
    bands = stg_bands.where(present("primary_subgenre")).select("band_id", "primary_subgenre")
    rows = scored.join(bands, "band_id").select("primary_subgenre", "avg_review_pct")
    if albums is not None:
        counts = (albums.select("band_id", "scored_albums").join(bands, "band_id")
                  .groupBy("primary_subgenre").agg(F.sum("scored_albums").alias("n")))
    else:
        counts = rows.groupBy("primary_subgenre").agg(_n().alias("n"))
    qualifying = counts.where(F.col("n") >= min_albums).select("primary_subgenre")
    return rows.join(qualifying, "primary_subgenre", "left_semi")


def agg_genre_touring_intensity(fct: DataFrame, exact_distinct: bool = True) -> DataFrame:
    return (fct.where(present("primary_subgenre"))
            .groupBy("primary_subgenre")
            .agg(_distinct("ma_band_id", exact_distinct).alias("band_count"),
                 _n().alias("total_concerts"))
            .select("primary_subgenre", "band_count", "total_concerts",
                    F.round(ratio("total_concerts", "band_count"), 1)
                     .alias("avg_concerts_per_band")))


def agg_productivity_vs_reviews(stg_albums: DataFrame,
                                albums: DataFrame | None = None) -> DataFrame:
    """Reviewed albums per band, bucketed. ``albums``: the ``band_albums``, if they are at hand."""
    if albums is not None:
        per_band = albums.where(F.col("reviewed_albums") > 0).select(
            "band_id", F.col("reviewed_albums").alias("album_count"),
            F.col("reviewed_score").alias("avg_review_score"))
    else:
        per_band = (stg_albums.where(F.col("review_count") > 0)
                    .groupBy("band_id")
                    .agg(_n().alias("album_count"),
                         F.avg("avg_review_pct").alias("avg_review_score")))
    return (per_band.groupBy(productivity_bucket("album_count").alias("productivity_bucket"))
            .agg(_n().alias("band_count"),
                 F.round(F.avg("avg_review_score"), 1).alias("avg_review_score"),
                 F.round(_approx_median("avg_review_score"), 1).alias("median_review_score"),
                 F.round(F.avg("album_count"), 1).alias("avg_albums")))


def agg_rating_vs_touring(fct: DataFrame) -> DataFrame:
    per_band = (fct.where(F.col("avg_review_score").isNotNull())
                .groupBy("ma_band_id")
                .agg(_n().alias("total_concerts"),
                     F.avg("avg_review_score").alias("avg_review_score")))
    return (per_band.groupBy(touring_bucket("total_concerts").alias("touring_bucket"))
            .agg(_n().alias("band_count"),
                 F.round(F.avg("avg_review_score"), 1).alias("avg_review_score"),
                 F.round(_approx_median("avg_review_score"), 1).alias("median_review_score")))


def agg_subgenre_share_over_time(fct: DataFrame) -> DataFrame:
    yearly = (fct.where(present("primary_subgenre"))
              .groupBy("event_year", "primary_subgenre").agg(_n().alias("concert_count")))
    return (yearly.withColumn("_total", parent_total("concert_count", ["event_year"]))
            .select("event_year", "primary_subgenre", "concert_count",
                    pct("concert_count", "_total", 1).alias("concert_share_pct")))


def performances(stg_songs: DataFrame, stg_setlists: DataFrame) -> DataFrame:
    """song_name, artist_name, venue_id of every song that was played.

    Songs meet their setlist on setlist_id; songs without one match no setlist and are left
    out before the shuffle, where they would be one hot key.
    """
    songs = (stg_songs.where(present("song_name"))
             .select("setlist_id", "song_name"))
    setlists = stg_setlists.select("setlist_id", "artist_name", "venue_id")
    return songs.join(setlists, "setlist_id").drop("setlist_id")


def agg_top_songs(stg_songs: DataFrame, stg_setlists: DataFrame, exact_distinct: bool = True,
                  performed: DataFrame | None = None) -> DataFrame:
    """Performances and distinct venues per (song, performing artist).

    Reads staging directly, so unmapped artists count too. ``performed``: the
    ``performances`` of the two tables, if they are at hand.
    """
    if performed is None:
        performed = performances(stg_songs, stg_setlists)
    return (performed.groupBy("song_name", "artist_name")
            .agg(_n().alias("performance_count"),
                 _distinct("venue_id", exact_distinct).alias("unique_venue_count")))


def marts(stg: dict[str, DataFrame], fct: DataFrame | None = None,
          performed: DataFrame | None = None,
          albums: DataFrame | None = None) -> dict[str, DataFrame]:
    """All fourteen marts; pass a materialised ``fct`` to avoid recomputing it, the songs'
    ``performed`` if their join is planned elsewhere, and written ``band_albums``."""
    if fct is None:
        fct = fct_concerts(stg["stg_setlists"], stg["stg_band_mapping"], stg["stg_bands"],
                           stg["stg_songs"], stg["stg_albums"], albums)
    return {
        "fct_concerts": fct,
        "dim_bands": dim_bands(stg["stg_bands"], stg["stg_band_mapping"], stg["stg_albums"], fct,
                               albums),
        "dim_venues": dim_venues(stg["stg_setlists"]),
        "agg_concerts_by_country": agg_concerts_by_country(fct),
        "agg_concerts_over_time": agg_concerts_over_time(fct),
        "agg_country_genre_affinity": agg_country_genre_affinity(stg["stg_bands"]),
        "agg_festival_seasonality": agg_festival_seasonality(fct),
        "agg_genre_lifecycle": agg_genre_lifecycle(stg["stg_albums"], stg["stg_bands"],
                                                   albums=albums),
        "agg_genre_review_distribution": agg_genre_review_distribution(
            stg["stg_albums"], stg["stg_bands"], albums=albums),
        "agg_genre_touring_intensity": agg_genre_touring_intensity(fct),
        "agg_productivity_vs_reviews": agg_productivity_vs_reviews(stg["stg_albums"], albums),
        "agg_rating_vs_touring": agg_rating_vs_touring(fct),
        "agg_subgenre_share_over_time": agg_subgenre_share_over_time(fct),
        "agg_top_songs": agg_top_songs(stg["stg_songs"], stg["stg_setlists"], performed=performed),
    }
