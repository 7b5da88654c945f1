"""Ingest selection: artist match, page rule, flatten, incremental."""

import json

import pytest

from conftest import rows
from gigframe.plans.ingest import (mark_processed, match_artists, read_processed,
                                   top_bands_by_reviews, unprocessed)
from gigframe.sources.pages import (flatten_setlists, flatten_songs, page_gaps, read_pages,
                                    select_pages)
from gigframe.sources.schemas import ARTIST_CANDIDATES, RAW_ALBUMS, RAW_BANDS


def test_match_prefers_exact_then_rank(spark):
    bands = spark.createDataFrame([("1", "Slayer"), ("2", "Kreator"), ("3", "Nobody")],
                                  "band_id string, band_name string")
    cands = spark.createDataFrame([
        ("1", "Slayer", 0, "Slayer UK", "m-uk"), ("1", "Slayer", 1, "SLAYER", "m-us"),
        ("2", "Kreator", 0, "Kreator Tribute", "m-t"),
    ], ARTIST_CANDIDATES)
    got = rows(match_artists(bands, cands), "ma_band_id", "sfm_mbid", "sfm_artist_name",
               "match_type")
    assert got == [("1", "m-us", "SLAYER", "exact"), ("2", "m-t", "Kreator Tribute", "fuzzy")]


def test_match_drops_missing_mbid(spark):
    bands = spark.createDataFrame([("1", "Slayer")], "band_id string, band_name string")
    cands = spark.createDataFrame([("1", "Slayer", 0, "Slayer", "")], ARTIST_CANDIDATES)
    assert match_artists(bands, cands).count() == 0


def test_top_bands_ignores_unparseable_counts(spark):
    albums = spark.createDataFrame([
        ("1", "a", "EP", "1990", "10 (50%)"), ("1", "b", "EP", "1991", "12 reviews (3%)"),
        ("2", "c", "EP", "1990", "7 (70%)"), ("2", "d", "EP", "1990", "5 (70%)"),
        ("3", "e", "EP", "1990", "No Reviews"), ("4", "f", "EP", "1990", "99 (9%)"),
    ], RAW_ALBUMS)
    bands = spark.createDataFrame([
        ("1", "One", "X", "g", "s"), ("2", "Two", "X", "g", "s"), ("2", "Two (dup)", "Y", "g", "s"),
        ("3", "Three", "X", "g", "s"),
    ], RAW_BANDS)
    got = rows(top_bands_by_reviews(albums, bands, n=2), "band_id", "band_name", "total_reviews")
    # band 4 is in the top 2 by reviews but has no band row: dropped, as the original ingester does
    assert got == [("2", "Two", 12)]


def test_unprocessed_is_anti_join(spark):
    bands = spark.createDataFrame([("1", "A"), ("2", "B")], "band_id string, band_name string")
    done = spark.createDataFrame([("1",), ("1",)], "band_id string")
    assert rows(unprocessed(bands, done), "band_id") == [("2",)]


def _page(mbid, page, total, setlists, ipp=2):
    return {"mbid": mbid, "page": page, "itemsPerPage": ipp, "total": total, "setlist": setlists}


def _sl(i, sets=None, **kw):
    d = {"id": i, "eventDate": "23-08-2019", "artist": {"mbid": "m", "name": "A"},
         "venue": {"id": "v", "name": "V", "city": {"name": "C", "coords": {"lat": 1.5},
                                                   "country": {"code": "US", "name": "USA"}}}}
    if sets is not None:
        d["sets"] = {"set": sets}
    d.update(kw)
    return d


def _write(tmp_path, pages):
    p = tmp_path / "pages.json"
    p.write_text("\n".join(json.dumps(x) for x in pages))
    return str(p)


def test_flatten_defaults(spark, tmp_path):
    pages = [_page("m", 1, 2, [
        _sl("s1"),  # no sets: a setlist record, no songs
        _sl("s2", sets=[{"name": "Encore", "encore": 1,
                         "song": [{"name": "Angel", "cover": {}},
                                  {"name": "Cover", "cover": {"name": "Other"}, "tape": True}]},
                        {"song": [{"name": "NoEncore"}]}], tour={"name": "T"}),
    ])]
    df = read_pages(spark, _write(tmp_path, pages))
    sl = rows(flatten_setlists(df), "setlist_id", "state", "latitude", "longitude", "tour_name")
    assert sl == [("s1", "", 1.5, None, ""), ("s2", "", 1.5, None, "T")]
    songs = rows(flatten_songs(df), "song_name", "set_name", "encore", "is_cover",
                 "cover_artist_name", "is_tape")
    assert songs == [("Angel", "Encore", 1, False, "", False),
                     ("Cover", "Encore", 1, True, "Other", True),
                     ("NoEncore", "", 0, False, "", False)]


def test_page_rule(spark, tmp_path):
    s = [_sl("x")]
    pages = [
        # artist a: pages 1, 2 kept; page 2 reaches total (2*2 >= 4), so 3 is not fetched
        _page("a", 1, 4, s), _page("a", 2, 4, s), _page("a", 3, 4, s),
        # artist b: page 2 is empty, so 3 is not fetched
        _page("b", 1, 9, s), _page("b", 2, 9, []), _page("b", 3, 9, s),
        # artist c: page 2 missing: landed pages are kept, the gap is only reported
        _page("c", 1, 9, s), _page("c", 3, 9, s),
        # artist d: 7 pages of 1, cap at 5
        *[_page("d", p, 7, s, ipp=1) for p in range(1, 8)],
    ]
    df = read_pages(spark, _write(tmp_path, pages))
    got = rows(select_pages(df, max_pages=5), "mbid", "page")
    assert got == [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 3)] + [
        ("d", p) for p in range(1, 6)]
    assert ("d", 7) in rows(select_pages(df), "mbid", "page")
    assert rows(page_gaps(df)) == [("c", 2, 3, 1)]


def test_pages_without_artist_or_number_are_kept(spark, tmp_path):
    s = [_sl("x")]
    pages = [_page(None, 1, 9, s), _page(None, 2, 9, []), _page(None, 3, 9, s),
             _page("a", None, 9, s), _page("a", 1, 1, s)]
    got = [(r.mbid, r.page) for r in select_pages(read_pages(spark, _write(tmp_path, pages))).collect()]
    assert sorted(got, key=repr) == sorted([(None, 1), ("a", None), ("a", 1)], key=repr)


def test_truncated_page_stops_the_read(spark, tmp_path):
    path = _write(tmp_path, [_page("a", p, 60, [_sl(str(p))]) for p in (1, 2, 3)])
    lines = open(path).read().splitlines()
    with open(path, "w") as f:
        f.write("\n".join([lines[0], lines[1][:40], *lines[2:]]) + "\n")
    with pytest.raises(Exception):
        flatten_setlists(read_pages(spark, path)).collect()


def test_processed_ids_and_repeated_mapping(spark, tmp_path):
    path = str(tmp_path / "processed")
    assert read_processed(spark, path).count() == 0
    one = spark.createDataFrame([("1", True), ("2", False)], "band_id string, found boolean")
    two = spark.createDataFrame([("2", False), ("3", True)], "band_id string, found boolean")
    for done in (one, two, two):
        mark_processed(done, path)
    assert rows(read_processed(spark, path)) == [("1", True), ("2", False), ("3", True)]
    bands = spark.createDataFrame([(str(k),) for k in range(5)], "band_id string")
    assert rows(unprocessed(bands, read_processed(spark, path))) == [("0",), ("4",)]


def test_unranked_hit_comes_last(spark):
    bands = spark.createDataFrame([("1", "Ab"), ("2", "Cd")], "band_id string, band_name string")
    hits = spark.createDataFrame(
        [("1", None, "x", "m0"), ("1", 0, "y", "m1"), ("2", None, "CD", "m2"), ("2", 0, "z", "m3")],
        "band_id string, rank int, name string, mbid string")
    got = {r.ma_band_id: (r.sfm_mbid, r.match_type) for r in match_artists(bands, hits).collect()}
    assert got == {"1": ("m1", "fuzzy"), "2": ("m2", "exact")}


def test_null_group_gets_positions(spark):
    from gigframe.sources.landing import dense_positions
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("g", "c")], "g string, k string")
    got = sorted(((r.g, r.k, r.pos) for r in dense_positions(df, "g", "k").collect()), key=repr)
    assert got == sorted([(None, "a", 1), (None, "b", 2), ("g", "c", 1)], key=repr)


def test_dense_positions_split_hot_groups(spark):
    from pyspark.sql import functions as F

    from gigframe.sources.landing import dense_positions
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string"))
         .alias("g"), F.col("id").cast("string").alias("k"))
    out = dense_positions(df, "g", "k", rows_per_bucket=100)
    stats = {r.g: (r.n, r.lo, r.hi, r.d, r.t) for r in out.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
        F.countDistinct("pos").alias("d"), F.max("group_total").alias("t")).collect()}
    for n, lo, hi, d, t in stats.values():
        assert (lo, hi, d, t) == (1, n, n, n)
    assert stats["hot"][0] == 1667
