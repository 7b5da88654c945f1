"""Plan-shape checks for the scale design (read from explain output)."""

import re

from pyspark.sql import functions as F

from gigframe.operators import keep_first
from gigframe.plans.catalog import Catalog
from conftest import rows
from gigframe.plans.ingest import append_landed, ingest_pages
from gigframe.session import scratch_path
from gigframe.sources.csv import load_raw
from gigframe.sources.landing import build_pages, write_landing_csv, write_pages
from gigframe.sources.pages import read_pages

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_reduces_before_the_shuffle(spark):
    # one key holds most rows: the map side keeps one row per key and task
    df = spark.range(100000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    out = keep_first(df, ["k"], [F.col("id").asc()])
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(tuple(r) for r in out.collect()) == [(0, 1), (1, 0)]


def test_aggregates_are_partial(spark):
    plan = _plan(Catalog(spark, SF_SMALL).genre_touring_intensity)
    assert "partial_count" in plan


def test_fact_song_join_reuses_setlist_partitioning(spark):
    plan = _plan(Catalog(spark, SF_SMALL).fct_concerts)
    # one exchange on setlist_id alone per input (setlist dedup, song aggregate),
    # none added for the join between them
    assert len(re.findall(r"hashpartitioning\(setlist_id#\d+, \d+\)", plan)) == 2


def test_scans_are_pruned(spark):
    plan = _plan(Catalog(spark, SF_SMALL).stg_songs)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_tax:double" \
        in plan
    assert "l_extendedprice" not in plan


def test_views_answer_sql(spark):
    cat = Catalog(spark, SF_SMALL)
    names = cat.register_views(prefix="t_")
    assert "t_fct_concerts" in names
    n = spark.sql("select count(*) from t_fct_concerts").collect()[0][0]
    assert n == cat.fct_concerts.count()


def test_landed_pages_append_to_loader_csv(spark):
    cat = Catalog(spark, SF_SMALL)
    pages = read_pages(spark, write_pages(build_pages(cat.raw["setlists"], cat.raw["songs"]),
                                          scratch_path(spark, "pages")))
    setlists, songs = ingest_pages(pages)
    landing = write_landing_csv(cat.raw, scratch_path(spark, "landing"))
    append_landed(setlists, songs, landing)
    raw = load_raw(spark, landing)
    assert raw["setlists"].count() == 2 * cat.raw["setlists"].count()
    assert raw["songs"].count() == cat.raw["songs"].count() + songs.count()


def test_materialized_models_cut_the_lineage(spark):
    cat = Catalog(spark, SF_SMALL)
    want = rows(cat.genre_touring_intensity)
    fresh = Catalog(spark, SF_SMALL).materialize("stg_bands", "fct_concerts")
    plan = _plan(fresh.genre_touring_intensity)
    assert "Scan ExistingRDD" in plan or "LogicalRDD" in plan or "Scan" in plan
    assert "lineitem" not in plan            # the fact's inputs are no longer in the plan
    assert rows(fresh.genre_touring_intensity) == want


def test_no_pair_products_in_any_registered_query(spark):
    """No cartesian product anywhere; a nested-loop join only ever joins a one-row total."""
    import __spark_entry__ as E

    allowed_nlj = {"country_genre_affinity", "tile_country_list", "tile_genre_list",
                   "tile_country_specialisation", "tile_genre_countries_lq",
                   "tile_genre_countries_count", "tile_headline_counts",
                   "tile_country_specialisation_chosen", "tile_genre_countries_lq_chosen",
                   "tile_genre_countries_count_chosen"}
    for name, fn in E.registry.QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in plan, name
        if "BroadcastNestedLoopJoin" in plan:
            assert name in allowed_nlj, name
