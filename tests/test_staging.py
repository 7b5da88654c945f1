"""Staging dedup rules on literal rows."""

import datetime as dt

from conftest import rows
from gigframe.plans.staging import stg_albums, stg_bands, stg_setlists, stg_songs
from gigframe.sources.schemas import RAW_ALBUMS, RAW_BANDS, RAW_SETLISTS, RAW_SONGS


def test_song_dedup_prefers_live_row_and_drops_tape_only(spark):
    raw = spark.createDataFrame([
        ("s1", "Angel", "A", 0, False, "", True),    # tape copy
        ("s1", "Angel", "A", 0, False, "", False),   # live copy: kept
        ("s1", "Raining", "A", 0, False, "", True),  # only a tape: dropped
        ("s1", "", "A", 0, False, "", False),        # no name: dropped
        ("s1", "Chemical", None, 1, None, "", None),  # NULL set and flags
    ], RAW_SONGS)
    out = stg_songs(raw)
    assert rows(out, "song_name", "set_name", "is_tape", "is_cover") == [
        ("Angel", "A", False, False), ("Chemical", None, False, False)]


def test_band_dedup_keeps_first_by_name(spark):
    raw = spark.createDataFrame([
        ("1", "Slayer (dup)", "DUP", "Dup Metal", "Unknown"),
        ("1", "Slayer", "United States", "Thrash Metal", "Active"),
        ("2", "Exodus", "United States", "Thrash Metal/Speed", "Active"),
    ], RAW_BANDS)
    assert rows(stg_bands(raw), "band_id", "band_name", "primary_subgenre") == [
        ("1", "Slayer", "Thrash Metal"), ("2", "Exodus", "Thrash Metal")]


def test_album_dedup_and_bad_years(spark):
    raw = spark.createDataFrame([
        ("1", "Reign", "Full-length", "1986", "3 (90%)"),
        ("1", "Reign", "Full-length", "1986", "5 (80%)"),   # more reviews: kept
        ("1", "Reign", "Full-length", "N/A", "9 (99%)"),    # bad year: dropped
        ("1", "Hell", "EP", "1984", "No Reviews"),
    ], RAW_ALBUMS)
    assert rows(stg_albums(raw), "album_name", "year", "review_count", "avg_review_pct") == [
        ("Hell", 1984, 0, None), ("Reign", 1986, 5, 80)]


def test_setlist_dedup_keeps_earliest(spark):
    d = dt.date(2019, 8, 23)
    base = ("a", "A", None, "v1", "V", "C", "", "US", "United States", 1.0, 2.0, "")
    raw = spark.createDataFrame([
        ("x", base[0], base[1], d + dt.timedelta(days=1), *base[3:]),
        ("x", base[0], base[1], d, *base[3:]),
    ], RAW_SETLISTS)
    out = stg_setlists(raw)
    assert rows(out, "setlist_id", "event_date", "event_year", "event_month") == [
        ("x", d, 2019, 8)]


def test_reviewed_only_equals_filter_after_dedup(spark):
    from conftest import SF_ORACLE
    from gigframe.sources.adapters import raw_albums
    raw = raw_albums(spark, SF_ORACLE)
    a = stg_albums(raw).where("review_count > 0")
    b = stg_albums(raw, reviewed_only=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
