"""A second landing rewrites the months that it touches, and the fact equals a full rebuild."""

import os

import pytest
from pyspark.sql import functions as F

from gigframe.plans import marts as M
from gigframe.plans import staging as S
from gigframe.plans.incremental import refresh_fact
from gigframe.session import scratch_path
from gigframe.sources.adapters import raw_tables
from gigframe.sources.warehouse import Warehouse

from conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def raw(spark):
    return raw_tables(spark, SF_SMALL)


def _stg(raw):
    return {"stg_band_mapping": S.stg_band_mapping(raw["band_mapping"]),
            "stg_bands": S.stg_bands(raw["bands"]), "stg_albums": S.stg_albums(raw["albums"])}


def _fact(raw, setlists, songs):
    stg = _stg(raw)
    return M.fct_concerts(S.stg_setlists(setlists), stg["stg_band_mapping"], stg["stg_bands"],
                          S.stg_songs(songs), stg["stg_albums"])


def _refreshed(spark, raw, before, landed):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.write_month_partitioned(_fact(raw, before["setlists"], before["songs"]), "fct_concerts", "marts")
    old = set(wh.read("fct_concerts", "marts").inputFiles())
    every = {n: before[n].unionByName(landed[n]) for n in ("setlists", "songs")}
    months = refresh_fact(wh, every, landed, _stg(raw))
    got = wh.read("fct_concerts", "marts")
    assert _same(got.drop("event_month_start"), _fact(raw, every["setlists"], every["songs"]))
    new = set(got.inputFiles()) - old
    assert {os.path.basename(os.path.dirname(f)).split("=")[1] for f in new} <= set(months)
    return months


def test_new_moved_and_re_sent_setlists(spark, raw):
    setlists, songs = raw["setlists"], raw["songs"]
    ids = [r[0] for r in setlists.select("setlist_id").distinct().orderBy("setlist_id").limit(4).collect()]
    new, moved, again, gets_songs = ids
    before = {"setlists": setlists.where(F.col("setlist_id") != new),
              "songs": songs.where(~F.col("setlist_id").isin(new, gets_songs))}
    move = setlists.where(F.col("setlist_id") == moved).withColumn(
        "event_date", F.add_months("event_date", -200))
    landed = {"setlists": setlists.where(F.col("setlist_id").isin(new, again)).unionByName(move),
              "songs": songs.where(F.col("setlist_id").isin(new, gets_songs))}
    months = _refreshed(spark, raw, before, landed)
    assert 1 < len(months) <= 8


def test_rows_without_id_or_date_and_an_empty_landing(spark, raw):
    setlists, songs = raw["setlists"], raw["songs"]
    none = {"setlists": setlists.limit(0), "songs": songs.limit(0)}
    whole = {"setlists": setlists, "songs": songs}
    assert _refreshed(spark, raw, whole, none) == []
    nameless = setlists.orderBy("setlist_id").limit(3).withColumn(
        "setlist_id", F.lit(None).cast("string"))
    dateless = setlists.orderBy(F.desc("setlist_id")).limit(2).withColumn(
        "event_date", F.lit(None).cast("date"))
    landed = {"setlists": nameless.unionByName(dateless),
              "songs": songs.limit(2).withColumn("setlist_id", F.lit(None).cast("string"))}
    _refreshed(spark, raw, whole, landed)
