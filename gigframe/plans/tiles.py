"""Dashboard queries over the marts, one function per tile.

The dashboard's local pandas steps (median order, describe, cumulative sum,
code lookup, head) run here as Spark aggregates and windows. Top-k queries get
the grain key as tie-break so the result is deterministic. Where a tile takes
a user's choice (a country, a genre), passing ``None`` answers it for every
choice at once with a per-group top-k window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import song_label
from ..operators.joins import fixed_broadcast
from ..operators.stats import box_stats_by, describe_by
from ..sources.schemas import ALPHA2_TO_ALPHA3


def top_k(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Global top-n: each partition keeps n rows, the merge sees n per partition."""
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, group: str, n: int, *order: Column) -> DataFrame:
    """n rows per group; WindowGroupLimit trims each group map-side."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def headline_counts(dim_bands: DataFrame, fct: DataFrame, top_songs: DataFrame,
                    by_country: DataFrame) -> DataFrame:
    """Four one-row counts side by side (each a global partial aggregate)."""
    a = dim_bands.where(F.col("has_setlist_data")).agg(F.count(F.lit(1)).alias("bands_with_setlists"))
    b = fct.agg(F.count(F.lit(1)).alias("total_concerts"))
    c = top_songs.agg(F.count(F.lit(1)).alias("song_artist_pairs"))
    d = by_country.agg(F.count(F.lit(1)).alias("country_code_name_pairs"))
    return a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(c)).crossJoin(F.broadcast(d))


def touring_top(intensity: DataFrame, min_bands: int = 2, n: int = 20) -> DataFrame:
    return top_k(intensity.where(F.col("band_count") >= min_bands), n,
                 F.col("avg_concerts_per_band").desc(), F.col("primary_subgenre").asc())


def rating_long(rating: DataFrame) -> DataFrame:
    """Mean and median per bucket as (bucket, metric, value) rows for a bar chart."""
    return rating.unpivot(["touring_bucket"], ["avg_review_score", "median_review_score"],
                          "metric", "value")


def concerts_per_year(over_time: DataFrame, first_year: int = 1980,
                      last_year: int = 2025) -> DataFrame:
    return (over_time.where(F.col("event_year").between(first_year, last_year))
            .groupBy("event_year").agg(F.sum("concert_count").alias("concert_count"))
            .orderBy("event_year"))


def subgenre_share_top_other(intensity: DataFrame, share: DataFrame, n: int = 10,
                             first_year: int = 1990, last_year: int = 2025) -> DataFrame:
    """Yearly share of the n most-toured subgenres, the rest summed as 'Other'.

    The top-n list has n rows by construction, so it is broadcast; the share
    rows are relabelled in place and summed per (year, label).
    """
    top = (top_k(intensity, n, F.col("total_concerts").desc(), F.col("primary_subgenre").asc())
           .select("primary_subgenre", F.lit(True).alias("_top")))
    tagged = (share.where(F.col("event_year").between(first_year, last_year))
              .join(fixed_broadcast(top), "primary_subgenre", "left")
              .select("event_year",
                      F.when(F.col("_top"), F.col("primary_subgenre")).otherwise(F.lit("Other"))
                       .alias("primary_subgenre"),
                      "concert_share_pct"))
    return (tagged.groupBy("event_year", "primary_subgenre")
            .agg(F.round(F.sum("concert_share_pct"), 1).alias("concert_share_pct")))


def alpha3_lookup(spark: SparkSession) -> DataFrame:
    rows = sorted(ALPHA2_TO_ALPHA3.items())
    return spark.createDataFrame(rows, "country_code string, iso_alpha3 string")


def country_map(by_country: DataFrame) -> DataFrame:
    """Countries with their alpha-3 code; codes without one are dropped."""
    lookup = alpha3_lookup(by_country.sparkSession)
    return by_country.join(fixed_broadcast(lookup), "country_code", "inner")


def top_countries(by_country: DataFrame, n: int = 20) -> DataFrame:
    return (top_k(by_country, n, F.col("concert_count").desc(), F.col("country_code").asc(),
                  F.col("country_name").asc())
            .select("country_name", "concert_count"))


def top_songs_tile(top_songs: DataFrame, n: int = 30) -> DataFrame:
    return (top_k(top_songs, n, F.col("performance_count").desc(), F.col("song_name").asc(),
                  F.col("artist_name").asc())
            .withColumn("label", song_label("song_name", "artist_name")))


def review_genres(distribution: DataFrame, n: int = 20) -> DataFrame:
    counts = distribution.groupBy("primary_subgenre").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, n, F.col("n").desc(), F.col("primary_subgenre").asc())


def _select_genres(df: DataFrame, genres: Sequence[str] | DataFrame | None,
                   default: DataFrame) -> DataFrame:
    if genres is None:  # the top-n list: its length is fixed
        return df.join(fixed_broadcast(default.select("primary_subgenre")), "primary_subgenre",
                       "left_semi")
    if isinstance(genres, DataFrame):
        return df.join(genres.select("primary_subgenre"), "primary_subgenre", "left_semi")
    return df.where(F.col("primary_subgenre").isin(list(genres)))


def review_box(distribution: DataFrame, genres: Sequence[str] | DataFrame | None = None,
               n_default: int = 20) -> DataFrame:
    """Box statistics for the chosen genres (default: the top-20 list), by median."""
    sel = _select_genres(distribution, genres, review_genres(distribution, n_default))
    return (box_stats_by(sel, "primary_subgenre", "avg_review_pct")
            .orderBy(F.col("median").desc(), F.col("primary_subgenre").asc()))


def review_summary(distribution: DataFrame, genres: Sequence[str] | DataFrame | None = None,
                   n_default: int = 20) -> DataFrame:
    sel = _select_genres(distribution, genres, review_genres(distribution, n_default))
    return (describe_by(sel, "primary_subgenre", "avg_review_pct")
            .orderBy(F.col("median").desc(), F.col("primary_subgenre").asc()))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def country_specialisation(affinity: DataFrame, country: str | None = None,
                           n: int = 15) -> DataFrame:
    order = (F.col("location_quotient").desc(), F.col("primary_subgenre").asc())
    if country is not None:
        return top_k(affinity.where(F.col("country") == F.lit(country)), n, *order)
    return top_k_per_group(affinity, "country", n, *order)


def genre_countries_lq(affinity: DataFrame, genre: str | None = None, n: int = 15) -> DataFrame:
    """Countries for a genre by LQ; the page shows max(5, min(15, rows)) = 15 at most."""
    order = (F.col("location_quotient").desc(), F.col("country").asc())
    if genre is not None:
        return top_k(affinity.where(F.col("primary_subgenre") == F.lit(genre)), n, *order)
    return top_k_per_group(affinity, "primary_subgenre", n, *order)


def genre_countries_count(affinity: DataFrame, genre: str | None = None,
                          n: int = 20) -> DataFrame:
    order = (F.col("band_count").desc(), F.col("country").asc())
    if genre is not None:
        sel = affinity.where(F.col("primary_subgenre") == F.lit(genre))
        return top_k(sel, n, *order).select("primary_subgenre", "country", "band_count")
    return (top_k_per_group(affinity, "primary_subgenre", n, *order)
            .select("primary_subgenre", "country", "band_count"))


def lifecycle_genres(lifecycle: DataFrame, n: int = 20) -> DataFrame:
    totals = lifecycle.groupBy("primary_subgenre").agg(F.sum("new_bands").alias("total"))
    return top_k(totals, n, F.col("total").desc(), F.col("primary_subgenre").asc())


def lifecycle_cumulative(lifecycle: DataFrame, genres: Sequence[str] | DataFrame | None = None,
                         n_default: int = 20) -> DataFrame:
    """New and running total of bands per year for the chosen genres.

    Years without debuts get no row (no gap filling), as in the page.
    """
    sel = _select_genres(lifecycle, genres, lifecycle_genres(lifecycle, n_default))
    w = (Window.partitionBy("primary_subgenre").orderBy("debut_year")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (sel.select("debut_year", "primary_subgenre", "new_bands",
                       F.sum("new_bands").over(w).alias("cumulative_bands"))
            .orderBy("primary_subgenre", "debut_year"))
