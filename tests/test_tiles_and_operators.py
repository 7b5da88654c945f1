"""Tiles and operators on literal rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from gigframe.operators import box_stats_by, describe_by, keep_first, quality_report
from gigframe.plans import tiles


def test_cumulative_has_no_gap_rows(spark):
    lc = spark.createDataFrame([(1980, "Doom", 2), (1982, "Doom", 3)],
                               "debut_year bigint, primary_subgenre string, new_bands bigint")
    got = rows(tiles.lifecycle_cumulative(lc, ["Doom"]), "debut_year", "cumulative_bands")
    assert got == [(1980, 2), (1982, 5)]


def test_top_other_relabels_and_sums(spark):
    intensity = spark.createDataFrame(
        [("A", 1, 10), ("B", 1, 5), ("C", 1, 1)],
        "primary_subgenre string, band_count bigint, total_concerts bigint")
    share = spark.createDataFrame(
        [(2000, "A", 50.0), (2000, "B", 30.0), (2000, "C", 20.0), (1980, "A", 100.0)],
        "event_year bigint, primary_subgenre string, concert_share_pct double")
    got = rows(tiles.subgenre_share_top_other(intensity.withColumn(
        "avg_concerts_per_band", F.lit(1.0)), share, n=1))
    assert got == [(2000, "A", 50.0), (2000, "Other", 50.0)]


def test_keep_first(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "z")], "k int, v string")
    got = rows(keep_first(df, ["k"], [F.col("v").asc_nulls_first()]))
    assert got == [(1, "a"), (2, None)]


def test_key_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    got = {r.check_name: r.failures for r in quality_report({"t": (df, ["k"])}).collect()}
    assert got == {"not_null": 2, "unique": 1}


def test_box_and_describe_match_pandas(spark):
    rng = np.random.default_rng(7)
    vals = list(rng.integers(0, 101, size=200)) + [0, 0, 100]
    pdf = pd.DataFrame({"g": ["x"] * len(vals), "v": [int(v) for v in vals]})
    df = spark.createDataFrame(pdf, "g string, v bigint")
    box = box_stats_by(df, "g", "v").collect()[0]
    q1, med, q3 = np.percentile(pdf.v, [25, 50, 75])
    assert (box.q1, box.median, box.q3) == pytest.approx((q1, med, q3))
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = pdf.v[(pdf.v >= lo) & (pdf.v <= hi)]
    assert (box.whisker_low, box.whisker_high) == (inside.min(), inside.max())
    assert box.n_outliers == int(((pdf.v < lo) | (pdf.v > hi)).sum())
    d = describe_by(df, "g", "v").collect()[0]
    s = pdf.v.agg(["count", "mean", "median", "std", "min", "max"]).round(1)
    assert (d.albums, d.mean, d.median, d.std_dev, d.min, d.max) == pytest.approx(tuple(s))


def test_describe_single_row_std_is_null(spark):
    df = spark.createDataFrame([("x", 5)], "g string, v bigint")
    assert describe_by(df, "g", "v").collect()[0].std_dev is None


def test_approx_distinct_option_is_close(spark):
    from gigframe.plans.catalog import Catalog
    from gigframe.plans.marts import agg_genre_touring_intensity
    from conftest import SF_SMALL
    fct = Catalog(spark, SF_SMALL).fct_concerts
    exact = {r.primary_subgenre: r.band_count for r in agg_genre_touring_intensity(fct).collect()}
    approx = {r.primary_subgenre: r.band_count
              for r in agg_genre_touring_intensity(fct, exact_distinct=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= max(1, 0.05 * exact[k]) for k in exact)


def test_single_choice_tiles_equal_the_per_group_form(spark):
    from gigframe.plans.catalog import Catalog
    from conftest import SF_ORACLE
    aff = Catalog(spark, SF_ORACLE).country_genre_affinity
    country = aff.orderBy(F.col("band_count").desc(), "country").first().country
    genre = aff.orderBy(F.col("band_count").desc(), "primary_subgenre").first().primary_subgenre
    pairs = [
        (tiles.country_specialisation(aff, country),
         tiles.country_specialisation(aff).where(F.col("country") == country)),
        (tiles.genre_countries_lq(aff, genre),
         tiles.genre_countries_lq(aff).where(F.col("primary_subgenre") == genre)),
        (tiles.genre_countries_count(aff, genre, n=5),
         tiles.genre_countries_count(aff, n=5).where(F.col("primary_subgenre") == genre)),
    ]
    for one, every in pairs:
        assert rows(one) == rows(every)
        assert one.count() > 0
