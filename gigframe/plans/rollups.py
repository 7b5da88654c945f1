"""Figures that roll up: month and genre states, merged over landings and to coarser groups.

The exact marts stay as they are. These tables have, beside additive counts, states
(``operators.sketches``) of distinct counts and medians. A landing's states are made from
its own rows, and merged with the ones there; a year or a season comes from months.
Concerts and albums must come in one landing only: additive counts count a repeated one twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import present
from ..operators.sketches import (distinct_count, distinct_merged, distinct_state, quantile,
                                  quantile_merged, quantile_state)

MONTH = ["event_year", "event_month"]


def month_states(fct: DataFrame) -> DataFrame:
    """event_year, event_month, concert_count and the states of its bands and countries."""
    return fct.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("concert_count"),
                                   distinct_state("ma_band_id").alias("bands"),
                                   distinct_state("country_code").alias("countries"))


def merge_month_states(*landings: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The states of all landings together, per month or per coarser group ``by``."""
    by = MONTH if by is None else by
    return reduce(DataFrame.unionByName, landings).groupBy(*by).agg(
        F.sum("concert_count").alias("concert_count"), distinct_merged("bands").alias("bands"),
        distinct_merged("countries").alias("countries"))


def distinct_figures(states: DataFrame) -> DataFrame:
    """The states' columns as numbers: unique_bands, unique_countries."""
    return (states.withColumn("unique_bands", distinct_count("bands"))
            .withColumn("unique_countries", distinct_count("countries"))
            .drop("bands", "countries"))


def review_states(stg_albums: DataFrame, stg_bands: DataFrame) -> DataFrame:
    """primary_subgenre, album_count and the state of its albums' review scores."""
    albums = (stg_albums.where((F.col("review_count") > 0) & F.col("avg_review_pct").isNotNull())
              .select("band_id", "avg_review_pct"))
    bands = stg_bands.where(present("primary_subgenre")).select("band_id", "primary_subgenre")
    return albums.join(bands, "band_id").groupBy("primary_subgenre").agg(
        F.count(F.lit(1)).alias("album_count"), quantile_state("avg_review_pct").alias("scores"))


def merge_review_states(*landings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, landings).groupBy("primary_subgenre").agg(
        F.sum("album_count").alias("album_count"), quantile_merged("scores").alias("scores"))


def review_medians(states: DataFrame) -> DataFrame:
    """primary_subgenre, album_count, median_review_score."""
    return states.select("primary_subgenre", "album_count",
                         quantile("scores", 0.5).alias("median_review_score"))
