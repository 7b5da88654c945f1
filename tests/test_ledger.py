"""Appends count once, whatever breaks off or is repeated."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from gigframe.plans.ingest import append_landed
from gigframe.session import scratch_path
from gigframe.sources.csv import read_raw_table
from gigframe.sources.ledger import Ledger, content_id
from gigframe.sources.schemas import RAW_BAND_MAPPING, RAW_SETLISTS, RAW_SONGS, RAW_TABLES
from gigframe.sources.sinks import write_append


def _tables(spark, ids):
    setlists = spark.createDataFrame(
        [(i, "m", "A", None, "v", "V", "C", "", "US", "USA", 1.5, None, "") for i in ids], RAW_SETLISTS)
    songs = spark.createDataFrame([(i, f"song {k}", "", 0, False, "", False)
                                   for i in ids for k in range(3)], RAW_SONGS)
    return setlists, songs


def _read(spark, landing, name):
    return read_raw_table(spark, RAW_TABLES[name], landing)


def test_repeated_and_broken_runs(spark):
    landing = scratch_path(spark, "landing")
    setlists, songs = _tables(spark, ["s1", "s2"])
    mapping = spark.createDataFrame([(1, "A", "m", "A", "exact"), (2, "B", "n", "B", "fuzzy")],
                                    RAW_BAND_MAPPING)
    broken = songs.withColumn("song_name", F.raise_error(F.lit("broken off")))
    with pytest.raises(PySparkException):
        append_landed(setlists, broken, landing, mapping, batch_id="run")
    ledger = Ledger(spark, landing)
    assert ledger.batches() == [] and ledger.folders(RAW_TABLES["setlists"].filename) == []
    assert append_landed(setlists, songs, landing, mapping, batch_id="run")
    assert not append_landed(setlists, songs, landing, mapping, batch_id="run")
    assert append_landed(*_tables(spark, ["s3"]), landing, mapping, batch_id="next")
    assert rows(_read(spark, landing, "setlists"), "setlist_id") == [("s1",), ("s2",), ("s3",)]
    assert _read(spark, landing, "songs").count() == 9
    assert _read(spark, landing, "band_mapping").count() == 2  # bands that have one keep it
    assert ledger.sweep() == []  # too young
    gone = ledger.sweep(older_than_hours=0)
    assert len(gone) == 1 and gone[0].startswith("run-")
    assert _read(spark, landing, "songs").count() == 9


def test_equal_rows_are_one_run_without_an_id(spark):
    landing = scratch_path(spark, "landing")
    setlists, songs = _tables(spark, ["s1", "s2", "s3"])
    assert append_landed(setlists, songs, landing)
    assert not append_landed(setlists.repartition(3), songs.orderBy(F.desc("song_name")), landing)
    assert append_landed(*_tables(spark, ["s1", "s2"]), landing)
    assert _read(spark, landing, "setlists").count() == 5


def test_content_ids_tell_batches_apart(spark):
    setlists, songs = _tables(spark, ["s1", "s2"])
    same = content_id({"a": setlists, "b": songs})
    assert same == content_id({"b": songs.repartition(5), "a": setlists})
    others = [{"a": setlists.limit(0), "b": songs}, {"a": setlists.union(setlists), "b": songs},
              {"b": songs}, {"a": setlists.withColumn("state", F.lit("x")), "b": songs}, {}]
    assert len({same, *(content_id(o) for o in others)}) == 6
    many = [content_id({"t": spark.range(n).selectExpr("'the same' as x")})
            for n in (4_000_000, 4_000_002)]
    assert many[0] != many[1]  # one row many times


def test_two_writers_of_one_batch(spark):
    landing = scratch_path(spark, "landing")
    one, two = Ledger(spark, landing), Ledger(spark, landing)
    df = spark.range(5)

    def save_late(frame, path):
        assert two.append("b", {"t": df}, lambda f, p: f.write.parquet(p))
        frame.write.parquet(path)

    assert not one.append("b", {"t": df}, save_late)
    assert len(one.folders("t")) == 1 and spark.read.parquet(*one.folders("t")).count() == 5
    for bad in ("", "../x", "a/b", "_x"):
        with pytest.raises(ValueError):
            one.append(bad, {"t": df}, lambda f, p: None)


def test_files_landed_by_others_count_too(spark):
    landing = scratch_path(spark, "landing")
    setlists, songs = _tables(spark, ["s1"])
    write_append(setlists, f"{landing}/{RAW_TABLES['setlists'].filename}", "csv")
    append_landed(*_tables(spark, ["s2"]), landing, batch_id="b")
    assert rows(_read(spark, landing, "setlists"), "setlist_id") == [("s1",), ("s2",)]
