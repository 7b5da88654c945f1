"""Atomic replacement of tables and releases, months replaced one by one, versions expired."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from gigframe.operators.quality import QualityError
from gigframe.plans.full_run import build_all
from gigframe.session import scratch_path
from gigframe.sources.adapters import raw_tables
from gigframe.sources.commits import CommitLog, Files
from gigframe.sources.landing import write_landing_csv
from gigframe.sources.warehouse import NO_MONTH, Warehouse

from conftest import SF_SMALL


def test_put_is_all_or_nothing_and_first_wins(spark):
    files = Files(spark, scratch_path(spark, "files"))
    assert files.names() == [] and not files.exists()
    assert files.put("a.json", {"x": "é"})
    assert not files.put("a.json", {"x": 2})
    assert files.read("a.json") == {"x": "é"} and files.names() == ["a.json"]


def test_commits_of_two_writers_both_count(spark):
    root = scratch_path(spark, "log")
    one, two = CommitLog(spark, root), CommitLog(spark, root)
    assert one.state() == {}

    def slow(old):
        if not two.numbers():  # another writer commits in between
            two.commit(lambda s: {**s, "b": 1})
        return {**old, "a": 1}

    one.commit(slow)
    assert two.state() == {"a": 1, "b": 1} and two.state(1) == {"b": 1}


@pytest.mark.parametrize("use_catalog", [False, True])
def test_a_write_that_breaks_off_leaves_the_old_table(spark, use_catalog):
    root = scratch_path(spark, "warehouse")
    wh = Warehouse(spark, root, use_catalog=use_catalog, prefix="broken_" if use_catalog else "")
    df = spark.range(100).withColumn("v", F.lit("old"))
    wh.write(df, "t", "marts")
    reader = Warehouse(spark, root, use_catalog=use_catalog, prefix=wh.prefix).read("t", "marts")
    fails = df.repartition(8).withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("x")))
                                         .otherwise(F.lit("new")))
    with pytest.raises(PySparkException):
        wh.write(fails, "t", "marts")
    assert rows(wh.read("t", "marts").groupBy("v").count()) == [("old", 100)]
    # A plan that reads the table may replace it, with another schema, too.
    wh.write(wh.read("t", "marts").withColumn("w", F.col("id") + 1), "t", "marts")
    assert wh.read("t", "marts").columns == ["id", "v", "w"]
    assert reader.count() == 100  # readers of the old version go on
    if use_catalog:
        assert spark.table("broken_marts.t").columns == ["id", "v", "w"]
    gone = wh.expire(keep=1, older_than_hours=0)
    assert len(gone) == 2 and wh.read("t", "marts").count() == 100
    assert len(Files(spark, wh.path("t", "marts")).names()) == 1


def test_a_young_folder_is_not_expired(spark):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    for k in range(3):
        wh.write(spark.range(k + 1), "t")
    assert wh.expire(keep=1) == [] and wh.read("t").count() == 3


def test_a_release_shows_all_tables_or_none(spark):
    root = scratch_path(spark, "warehouse")
    wh, other = Warehouse(spark, root), Warehouse(spark, root)
    with wh.release():
        wh.write(spark.range(1), "a", "marts")
        with pytest.raises(LookupError):
            other.read("a", "marts")
        assert wh.read("a", "marts").count() == 1  # its own run sees it
        wh.write(spark.range(2), "b", "marts")
    assert (other.read("a", "marts").count(), other.read("b", "marts").count()) == (1, 2)
    with pytest.raises(ZeroDivisionError):
        with wh.release():
            wh.write(spark.range(10), "a", "marts")
            raise ZeroDivisionError
    assert other.read("a", "marts").count() == wh.read("a", "marts").count() == 1
    assert len(wh.log.numbers()) == 1


def test_views_are_mended_after_a_commit_without_them(spark):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), use_catalog=True, prefix="mend_")
    wh.write(spark.range(3), "t", "marts")
    sync, wh.sync_views = wh.sync_views, lambda entries=None: None
    wh.write(spark.range(4), "t", "marts")
    assert spark.table("mend_marts.t").count() == 3 and wh.read("t", "marts").count() == 4
    sync()
    assert spark.table("mend_marts.t").count() == 4


def _landing(spark, raw):
    return write_landing_csv(raw, scratch_path(spark, "landing"))


def test_a_run_that_fails_its_checks_is_not_released(spark):
    raw = raw_tables(spark, SF_SMALL)
    root = scratch_path(spark, "warehouse")
    build_all(spark, _landing(spark, raw), root, use_catalog=False)
    wh = Warehouse(spark, root)
    before = rows(wh.read("agg_concerts_over_time", "marts"))
    entry = wh.entry("stg_bands", "staging")
    assert entry["nulls"] == 0 and entry["rows"] == wh.read("stg_bands", "staging").count()
    nameless = raw["bands"].withColumn("band_id", F.expr("if(band_id = '7', null, band_id)"))
    with pytest.raises(QualityError, match="stg_bands.band_id not_null=1"):
        build_all(spark, _landing(spark, {**raw_tables(spark, SF_SMALL), "bands": nameless}), root,
                  use_catalog=False, empty_as=None)
    assert rows(wh.read("agg_concerts_over_time", "marts")) == before


def _fact(spark, *rs):
    return spark.createDataFrame([(c, d, g) for c, d, g in rs],
                                 "concert_id string, event_date string, primary_subgenre string"
                                 ).withColumn("event_date", F.to_date("event_date"))


@pytest.mark.parametrize("use_catalog", [False, True])
def test_months_are_replaced_alone(spark, use_catalog):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), use_catalog=use_catalog,
                   prefix="months_" if use_catalog else "")
    wh.write_month_partitioned(_fact(spark, ("a", "1999-01-05", "x"), ("b", "1999-02-05", "x"),
                                     ("c", "1999-03-05", "y"), ("n", None, "y")), "f", "marts",
                               cluster_by=("primary_subgenre",))
    was = {os.path.dirname(f) for f in wh.read("f", "marts").inputFiles()}
    with pytest.raises(ValueError):
        wh.replace_months(_fact(spark, ("z", "1999-03-09", "x")), ["1999-02-01"], "f", "marts",
                          cluster_by=("primary_subgenre",))
    wh.replace_months(_fact(spark, ("b2", "1999-02-07", "x"), ("d", "1999-05-07", "x")),
                      ["1999-02-01", "1999-01-01", "1999-05-01"], "f", "marts",
                      cluster_by=("primary_subgenre",))
    got = wh.read("f", "marts")
    assert rows(got, "concert_id") == [("b2",), ("c",), ("d",), ("n",)]  # January is gone
    now = {os.path.dirname(f) for f in got.inputFiles()}
    assert len([f for f in was if f.endswith(("=1999-03-01", f"={NO_MONTH}"))]) == 2
    plan = got.where("event_month_start = date '1999-03-01'")
    assert [r.concert_id for r in plan.collect()] == ["c"]
    assert now - was and was & now  # files of other months stay
    if use_catalog:
        assert rows(spark.table("months_marts.f"), "concert_id") == rows(got, "concert_id")
    wh.replace_months(_fact(spark, ("n2", None, "y")), [NO_MONTH], "f", "marts",
                      cluster_by=("primary_subgenre",))
    assert rows(wh.read("f", "marts"), "concert_id") == [("b2",), ("c",), ("d",), ("n2",)]


def test_many_versions_are_written_anew(spark, monkeypatch):
    from gigframe.sources import warehouse
    monkeypatch.setattr(warehouse, "MOST_VERSIONS", 2)
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.write_month_partitioned(_fact(spark, *[(str(m), f"2001-{m:02d}-03", "g")
                                              for m in range(1, 7)]), "f", cluster_by=())
    for m in (1, 2, 3):
        wh.replace_months(_fact(spark, (f"new{m}", f"2001-{m:02d}-09", "g")), [f"2001-{m:02d}-01"],
                          "f", cluster_by=())
        assert len(set(wh.entry("f")["months"].values())) <= 2
    assert rows(wh.read("f"), "concert_id") == [("4",), ("5",), ("6",), ("new1",), ("new2",), ("new3",)]


def test_a_second_run_lands_only_the_table_that_changed(spark, monkeypatch):
    from gigframe.plans import registry
    from gigframe.plans.catalog import Catalog
    from gigframe.sources import landing
    landed, write = [], landing.write_landing_csv

    def noted(raw, path, **given):
        landed.append((path, given.get("only")))
        return write(raw, path, **given)

    monkeypatch.setattr(landing, "write_landing_csv", noted)
    got = registry.QUERIES["full_run_replace"](spark, SF_SMALL)
    assert len({path for path, _ in landed}) == 1
    assert [only for _, only in landed] == [None, ["setlists"]]
    names = ("event_year", "event_month", "concert_count")
    assert rows(got, *names) == rows(Catalog(spark, SF_SMALL).concerts_over_time, *names)
