"""The full run over landed CSV files equals the in-memory plans."""

import os

from gigframe.plans.marts import marts
from gigframe.plans.full_run import build_all
from gigframe.plans.staging import staging
from gigframe.session import scratch_path
from gigframe.sources.adapters import raw_tables
from gigframe.sources.csv import load_raw
from gigframe.sources.landing import write_landing_csv

from conftest import SF_SMALL


def _null_to_empty(df):
    """An empty CSV text cell loads as ''."""
    return df.na.fill("")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_round_trip_keeps_raw_rows(spark):
    landing = write_landing_csv(raw_tables(spark, SF_SMALL), scratch_path(spark, "landing"))
    loaded = load_raw(spark, landing)
    expected = raw_tables(spark, SF_SMALL)
    for name, df in loaded.items():
        want = _null_to_empty(expected[name])
        assert df.columns == want.columns, name
        assert _same(df, want), name


def test_quotes_commas_backslashes_and_edge_blanks_round_trip(spark, tmp_path):
    from gigframe.sources.csv import read_raw_table
    from gigframe.sources.schemas import RAW_SONGS, RAW_TABLES
    from gigframe.sources.sinks import write_append
    names = ['7" Edit, live', 'The "X" Band', "back\\slash", ' edge ', '"', ',', '\\"', "", "é"]
    df = spark.createDataFrame([("s", n, "", 0, False, n, None) for n in names], RAW_SONGS)
    t = RAW_TABLES["songs"]
    write_append(df, os.path.join(str(tmp_path), t.filename), "csv")
    write_append(df, os.path.join(str(tmp_path), t.filename), "csv")
    got = read_raw_table(spark, t, str(tmp_path))
    assert sorted(r.song_name for r in got.collect()) == sorted(names * 2)
    assert sorted(r.cover_artist_name for r in got.collect()) == sorted(names * 2)


def test_moved_columns_stop_the_load(spark, tmp_path):
    import pytest

    from gigframe.sources.csv import read_header_named, read_typed
    from gigframe.sources.schemas import RAW_SONGS
    names = RAW_SONGS.fieldNames()
    moved = [names[1], names[0], *names[2:]]
    (tmp_path / "songs.csv").write_text(",".join(moved) + "\nA,s1,,0,false,,false\n")
    with pytest.raises(Exception):
        read_typed(spark, str(tmp_path / "songs.csv"), RAW_SONGS).collect()
    folder = tmp_path / "bands"
    folder.mkdir()
    (folder / "a.csv").write_text("Band ID,Name\n1,x\n")
    (folder / "b.csv").write_text("Name,Band ID\ny,2\n")
    with pytest.raises(Exception):
        read_header_named(spark, str(folder), {"Band_ID": "b", "Name": "n"}).collect()


def test_empty_as_null_option(spark):
    landing = write_landing_csv(raw_tables(spark, SF_SMALL), scratch_path(spark, "landing"))
    bands = load_raw(spark, landing, empty_as=None)["bands"]
    assert bands.where("genre = ''").count() == 0
    assert bands.where("genre is null").count() > 0


def test_full_run_matches_lazy_plans(spark):
    raw = raw_tables(spark, SF_SMALL)
    landing = write_landing_csv(raw, scratch_path(spark, "landing"))
    out = build_all(spark, landing, scratch_path(spark, "warehouse"))
    want_all = marts(staging({n: _null_to_empty(df) for n, df in raw.items()}))
    assert set(out) == set(want_all)
    for name, want in want_all.items():
        got = out[name].select(*want.columns)
        assert _same(got, want), name
    first_file = out["fct_concerts"].inputFiles()[0]
    assert os.path.basename(os.path.dirname(first_file)).startswith("event_month_start=")
    # tiles read the written marts under the lazy catalog's names
    from gigframe.plans import tiles
    from gigframe.plans.catalog import Catalog, written_catalog
    written, lazy = written_catalog(spark), Catalog(spark, SF_SMALL)
    assert _same(tiles.touring_top(written.genre_touring_intensity),
                 tiles.touring_top(want_all["agg_genre_touring_intensity"]))
    assert written.fct_concerts.count() == want_all["fct_concerts"].count()
    assert written.stg_bands.count() == lazy.stg_bands.count()


def test_bucketed_staging_joins_without_shuffle(spark):
    from gigframe.plans.marts import agg_top_songs

    raw = raw_tables(spark, SF_SMALL)
    landing = write_landing_csv(raw, scratch_path(spark, "landing"))
    build_all(spark, landing, scratch_path(spark, "warehouse"), check=False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        songs, setlists = spark.table("staging.stg_songs"), spark.table("staging.stg_setlists")
        plan = agg_top_songs(songs, setlists)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange hashpartitioning(setlist_id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_marts_from_band_albums_equal_marts_from_albums(spark):
    from pyspark.sql import functions as F

    from gigframe.plans import marts as M
    # Bands without reviews, without a score, with counts of 0 or unknown, and no band at all.
    albums = spark.createDataFrame(
        [(band, f"A{k}", "EP", year, count, pct) for k, (band, year, count, pct) in enumerate([
            ("1", 1990, 3, 80), ("1", 1985, 1, 55), ("1", 2001, 0, 40), ("2", 1999, 0, None),
            ("2", 1998, None, None), ("3", 2005, 4, None), (None, 1991, 2, 70), (None, 1980, 0, 10),
            ("4", 1971, 9, 90), ("9", 1975, 5, 20)])],
        "band_id string, album_name string, album_type string, year long, review_count long,"
        " avg_review_pct long")
    bands = spark.createDataFrame(
        [(b, f"B{b}", "FI", g, g, "Active") for b, g in
         [("1", "Doom"), ("2", "Doom"), ("3", "Folk"), ("4", "Folk"), ("5", None), ("6", "")]],
        "band_id string, band_name string, country string, genre string, primary_subgenre string,"
        " status string")
    mapping = spark.createDataFrame([(b, f"m{b}") for b in "12345"],
                                    "ma_band_id string, sfm_mbid string")
    songs = spark.createDataFrame([("s1", "x"), ("s1", "y")], "setlist_id string, song_name string")
    setlists = spark.createDataFrame([(f"s{k}", f"m{k}") for k in range(1, 7)],
                                     "setlist_id string, artist_mbid string")
    for c in ("artist_name", "venue_name", "city_name", "country_code", "country_name", "tour_name"):
        setlists = setlists.withColumn(c, F.lit("t"))
    setlists = setlists.withColumns({
        "event_date": F.lit("2000-02-03").cast("date"), "event_year": F.lit(2000),
        "event_month": F.lit(2), "latitude": F.lit(1.0), "longitude": F.lit(2.0)})
    figures = M.band_albums(albums)
    fct = M.fct_concerts(setlists, mapping, bands, songs, albums)
    pairs = [(fct, M.fct_concerts(setlists, mapping, bands, songs, albums, figures)),
             (M.dim_bands(bands, mapping, albums, fct),
              M.dim_bands(bands, mapping, albums, fct, figures)),
             (M.agg_genre_lifecycle(albums, bands), M.agg_genre_lifecycle(albums, bands,
                                                                          albums=figures)),
             (M.agg_productivity_vs_reviews(albums),
              M.agg_productivity_vs_reviews(albums, figures))]
    pairs += [(M.agg_genre_review_distribution(albums, bands, n),
               M.agg_genre_review_distribution(albums, bands, n, figures)) for n in (1, 2, 3)]
    for want, got in pairs:
        assert got.schema == want.schema
        assert _same(got, want), want.columns


def test_a_folder_run_groups_albums_by_band_once(spark, monkeypatch):
    from gigframe.plans import full_run
    from gigframe.sources.warehouse import Warehouse
    files, write = {}, Warehouse.write

    def noted(self, df, name, layer=None, **given):
        files[name] = df.inputFiles()
        return write(self, df, name, layer, **given)

    monkeypatch.setattr(Warehouse, "write", noted)
    landing = write_landing_csv(raw_tables(spark, SF_SMALL), scratch_path(spark, "landing"))
    full_run.build_all(spark, landing, scratch_path(spark, "warehouse"), use_catalog=False)
    for name in ("dim_bands", "agg_genre_lifecycle", "agg_productivity_vs_reviews"):
        assert not [f for f in files[name] if "/stg_albums/" in f], name
        assert [f for f in files[name] if "/band-albums-" in f], name
    assert [f for f in files["agg_genre_review_distribution"] if "/stg_albums/" in f]
