"""Month-partition pruning and the resumable stream."""

from gigframe.plans.catalog import Catalog
from gigframe.session import scratch_path
from gigframe.sources.sinks import concerts_between, write_month_partitioned
from gigframe.streaming.resume import replay_setlists_twice

from conftest import SF_SMALL


def test_month_pruning_reaches_the_scan(spark):
    fct = Catalog(spark, SF_SMALL).fct_concerts
    path = write_month_partitioned(fct, scratch_path(spark, "fct"))
    df = concerts_between(spark, path, "1997-03-15", "1998-06-10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month_start" in plan
    want = fct.where("event_date between date'1997-03-15' and date'1998-06-10'")
    assert df.exceptAll(want).count() == 0 and want.exceptAll(df).count() == 0


def test_stream_second_run_emits_no_resent_rows(spark):
    out = replay_setlists_twice(spark, SF_SMALL)
    assert out.where("venue_id = 'vDUP'").count() == 0
    assert out.count() == out.select("setlist_id").distinct().count()


def test_page_stream_rerun_without_new_files_adds_nothing(spark):
    import os

    from gigframe.sources.landing import build_pages, write_pages
    from gigframe.streaming.pages import read_ingested, run_page_ingest

    cat = Catalog(spark, SF_SMALL)
    base = scratch_path(spark, "stream-pages-test")
    landing, out, ckpt = (os.path.join(base, x) for x in ("landing", "out", "ckpt"))
    write_pages(build_pages(cat.raw["setlists"], cat.raw["songs"]), os.path.join(landing, "d0"))
    run_page_ingest(spark, os.path.join(landing, "*"), out, ckpt)
    n = read_ingested(spark, out, "setlists").count()
    run_page_ingest(spark, os.path.join(landing, "*"), out, ckpt)
    assert read_ingested(spark, out, "setlists").count() == n == cat.raw["setlists"].count()


def test_bounded_state_dedup_within_watermark(spark):
    import os

    from pyspark.sql import functions as F

    from gigframe.sources.adapters import raw_setlists, resent_setlists
    from gigframe.sources.schemas import RAW_SETLISTS
    from gigframe.streaming.resume import run_incremental

    base = scratch_path(spark, "stream-wm")
    landing, sink, ckpt = (os.path.join(base, x) for x in ("landing", "sink", "ckpt"))
    flat = raw_setlists(spark, SF_SMALL, with_duplicates=False)
    # drop 1: originals; drop 2: re-sends; drop 3: a concert of long ago, not seen before
    flat.write.mode("append").parquet(landing)
    run_incremental(spark, landing, sink, ckpt, RAW_SETLISTS, ["setlist_id"],
                    resend_delay="30 days")
    resent_setlists(flat).write.mode("append").parquet(landing)
    run_incremental(spark, landing, sink, ckpt, RAW_SETLISTS, ["setlist_id"],
                    resend_delay="30 days")
    old = flat.limit(1).withColumns({"setlist_id": F.lit("old"),
                                     "event_date": F.lit("1905-06-01").cast("date")})
    old.write.mode("append").parquet(landing)
    run_incremental(spark, landing, sink, ckpt, RAW_SETLISTS, ["setlist_id"],
                    resend_delay="30 days")
    out = spark.read.parquet(sink)
    assert out.where(F.col("venue_id") == "vDUP").count() == 0
    assert out.where(F.col("setlist_id") == "old").count() == 1
    assert out.count() == out.select("setlist_id").distinct().count() == flat.count() + 1


def test_page_stream_does_not_depend_on_batches(spark, tmp_path):
    import json

    from gigframe.streaming.pages import read_ingested, run_page_ingest

    def land(folder, page):
        folder.mkdir(exist_ok=True)
        body = {"mbid": "a", "page": page, "itemsPerPage": 20, "total": 60,
                "setlist": [{"id": f"s{page}", "eventDate": "01-02-2020"}]}
        (folder / f"{page}.json").write_text(json.dumps(body) + "\n")

    for name, per_batch in (("one", None), ("many", 1)):
        folder = tmp_path / name
        for page in (1, 2, 3):
            land(folder, page)
        out, ckpt = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-ckpt")
        run_page_ingest(spark, str(folder), out, ckpt, files_per_batch=per_batch)
        assert read_ingested(spark, out, "setlists").count() == 3
    folder = tmp_path / "drops"
    for page in (2, 1, 3):
        land(folder, page)
        run_page_ingest(spark, str(folder), str(tmp_path / "d-out"), str(tmp_path / "d-ckpt"))
    assert read_ingested(spark, str(tmp_path / "d-out"), "setlists").count() == 3


def test_hot_values_are_split_over_range_partitions(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from gigframe.sources.sinks import clustered, month_layout

    df = spark.range(60000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "US").otherwise((F.col("id") % 50).cast("string")).alias("country_code"),
        F.when(F.col("id") % 3 == 0, "Hot").otherwise((F.col("id") % 40).cast("string")).alias("primary_subgenre"),
        F.when(F.col("id") % 3 == 0, F.lit("2020-01-05"))
         .otherwise(F.concat(F.lit("20"), (F.col("id") % 19 + 10).cast("string"), F.lit("-05-01")))
         .cast("date").alias("event_date"))
    for out in (clustered(df, "country_code", partitions=32), month_layout(df)):
        n = Counter(r[0] for r in out.select(F.spark_partition_id()).collect())
        assert max(n.values()) < 2 * 60000 / len(n)


def test_bucket_count_follows_the_size():
    from gigframe.sources.warehouse import bucket_count

    assert [bucket_count(n, 100) for n in (0, 1, 100, 101, 250, 401, 1600)] == [1, 1, 1, 2, 4, 8, 16]


def test_given_settings_win(spark):
    from gigframe.session import build_session

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # The session's own core setting stands against our default.
        assert spark.sparkContext.getConf().contains("spark.ui.showConsoleProgress")
        assert build_session(shuffle_partitions=5).conf.get("spark.sql.shuffle.partitions") == "5"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_drops_are_written_once_and_land_whole(spark):
    import os

    from gigframe.sources.landing import build_pages
    from gigframe.sources.pages import read_pages
    from gigframe.streaming.pages import land_drop, split_drops, write_drops
    cat = Catalog(spark, SF_SMALL)
    pages = build_pages(cat.raw["setlists"], cat.raw["songs"])
    base = scratch_path(spark, "drops")
    landing = os.path.join(base, "landing")
    drops = write_drops(pages, os.path.join(base, "arriving"), 2)
    want = [p.count() for p in split_drops(pages, 2)]
    assert [read_pages(spark, d).count() for d in drops] == want and min(want) > 0
    land_drop(spark, drops[0], landing)
    assert read_pages(spark, os.path.join(landing, "*")).count() == want[0]
    land_drop(spark, drops[1], landing)
    assert read_pages(spark, os.path.join(landing, "*")).count() == sum(want)
    land_drop(spark, os.path.join(base, "arriving", "drop=7"), landing)  # no pages
    assert os.listdir(os.path.join(landing, "drop=7").removeprefix("file:")) == []


def test_pages_shuffle_songs_once_and_are_compressed(spark):
    import glob

    from gigframe.sources.landing import build_pages, write_pages
    from gigframe.sources.pages import read_pages, select_pages
    cat = Catalog(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build_pages(cat.raw["setlists"], cat.raw["songs"])._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Songs and setlists by setlist_id; before, songs also by (setlist_id, set_name, encore).
    assert plan.count("Exchange hashpartitioning(setlist_id") == 2
    path = write_pages(build_pages(cat.raw["setlists"], cat.raw["songs"]), scratch_path(spark, "pages"))
    files = path.removeprefix("file:")
    assert glob.glob(f"{files}/*.gz") and not glob.glob(f"{files}/*.txt")
    kept = select_pages(read_pages(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in kept  # before: all pages were shuffled
