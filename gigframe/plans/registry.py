"""Named queries over a data directory: one per operator group.

Every query reads the whole driver tables (through the adapters) and
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import adapters
from ..sources.adapters import RAW_BUILDERS
from ..sources.landing import build_pages, write_pages
from ..sources.pages import read_pages
from ..sources.sinks import concerts_between, write_month_partitioned
from . import ingest, quality, tiles
from .catalog import Catalog, catalog_for

Query = Callable[[SparkSession, str], DataFrame]


def _cat(spark: SparkSession, sf_dir: str) -> Catalog:
    ensure_checkpoint_dir(spark)
    return catalog_for(spark, sf_dir)


def _attr(name: str) -> Query:
    return lambda spark, sf_dir: getattr(_cat(spark, sf_dir), name)


def _landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the raw setlists/songs as API page files, then read them back."""
    path = write_pages(build_pages(adapters.raw_setlists(spark, sf_dir),
                                   adapters.raw_songs(spark, sf_dir)),
                       scratch_path(spark, "pages"))
    return read_pages(spark, path)


def _flatten(which: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _cat(spark, sf_dir)
        return ingest.ingest_pages(_landed_pages(spark, sf_dir))[which]
    return run


def _month_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cat(spark, sf_dir)
    path = write_month_partitioned(c.fct_concerts, scratch_path(spark, "fct_concerts"))
    return concerts_between(spark, path, "1997-03-15", "1998-06-10")


def _stream_pages(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        import os

        from ..streaming.pages import land_drop, read_ingested, run_page_ingest, write_drops
        c = _cat(spark, sf_dir)
        base = scratch_path(spark, "stream-pages")
        landing, out = os.path.join(base, "landing"), os.path.join(base, "out")
        checkpoint = os.path.join(base, "checkpoint")
        pages = build_pages(c.raw["setlists"], c.raw["songs"])
        for drop in write_drops(pages, os.path.join(base, "arriving"), 2):
            land_drop(spark, drop, landing)
            run_page_ingest(spark, os.path.join(landing, "*"), out, checkpoint)
        return read_ingested(spark, out, table)
    return run


def _load_csv(name: str) -> Query:
    """Land one raw table as CSV (header as the source writes it), load it back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        import os

        from ..sources.csv import read_raw_table
        from ..sources.landing import write_landing_csv
        from ..sources.schemas import RAW_TABLES
        c = _cat(spark, sf_dir)
        landing = scratch_path(spark, "landing")
        write_landing_csv({name: c.raw[name]}, landing, only=[name])
        return read_raw_table(spark, RAW_TABLES[name], landing)
    return run


def _append_csv(name: str) -> Query:
    """Append all landed tables in a run that breaks off, in one that ends, and in that one
    again; load one of them back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..sources.csv import read_raw_table
        from ..sources.schemas import RAW_TABLES
        c = _cat(spark, sf_dir)
        landing = scratch_path(spark, "landing")
        tables = c.raw["setlists"], c.raw["songs"]
        broken = c.raw["songs"].withColumn("song_name", F.raise_error(F.lit("broken off")))
        try:
            ingest.append_landed(tables[0], broken, landing, c.raw["band_mapping"], "run-1")
        except PySparkException:  # its setlists are written by then
            pass
        for _ in range(2):
            ingest.append_landed(*tables, landing, c.raw["band_mapping"], "run-1")
        return read_raw_table(spark, RAW_TABLES[name], landing)
    return run


def _ingest_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the bands to do, each recording what it found; a third adds nothing."""
    _cat(spark, sf_dir)
    path = scratch_path(spark, "processed")
    bands = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "cast(c_custkey as string) as band_id", "c_custkey % 3 <> 0 as found",
        "c_nationkey < 10 as first")
    for part in (bands.where("first"), bands, bands):
        todo = ingest.unprocessed(part, ingest.read_processed(spark, path))
        ingest.mark_processed(todo, path)
    return ingest.read_processed(spark, path)


def _page_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven landed pages for each customer: all wanted up to the cap of 5, or total reached
    on page 2, or page 4 empty, or page 2 missing (a gap drops nothing)."""
    from ..sources.pages import select_pages
    _cat(spark, sf_dir)
    pages = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "c_custkey % 4 as kind", "concat('m', cast(c_custkey as string)) as mbid",
        "explode(sequence(1, 7)) as page").selectExpr(
        "mbid", "page", "20 as itemsPerPage", "case when kind = 1 then 40 else 1000 end as total",
        """case when kind = 2 and page = 4 then array()
                else array(named_struct('id', concat(mbid, '-', page))) end as setlist""",
        "kind").where("not (kind = 3 and page = 2)")
    return select_pages(pages, max_pages=5).select("mbid", "page")


def _full_run(pick: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    """Land all raw tables as CSV, build and check every layer in a warehouse of folders."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..sources.landing import write_landing_csv
        from .full_run import build_all
        landing = write_landing_csv(_cat(spark, sf_dir).raw, scratch_path(spark, "landing"))
        return pick(build_all(spark, landing, scratch_path(spark, "warehouse"),
                              use_catalog=False))
    return run


def _full_run_catalog(pick: Callable[[SparkSession, str], DataFrame]) -> Query:
    """The same run as catalog tables, bucketed; ``pick`` reads them by name, after the
    databases' prefix."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        import uuid

        from ..sources.landing import write_landing_csv
        from .full_run import build_all
        landing = write_landing_csv(_cat(spark, sf_dir).raw, scratch_path(spark, "landing"))
        prefix = f"run_{uuid.uuid4().hex[:8]}_"
        build_all(spark, landing, scratch_path(spark, "warehouse"), prefix=prefix)
        return pick(spark, prefix)
    return run


def _full_run_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build from half of the setlists, build again from all, break a third run off after it
    has written a table; what readers see is the second. Only the setlists land twice."""
    from ..sources.landing import write_landing_csv
    from ..sources.warehouse import Warehouse
    from .full_run import build_all
    raw = _cat(spark, sf_dir).raw
    root = scratch_path(spark, "warehouse")
    landing = scratch_path(spark, "landing")
    write_landing_csv({**{n: raw[n] for n in RAW_BUILDERS},
                       "setlists": raw["setlists"].where("event_date < date '1995-06-30'")}, landing)
    build_all(spark, landing, root, use_catalog=False)
    write_landing_csv(raw, landing, only=["setlists"])
    build_all(spark, landing, root, use_catalog=False)
    wh = Warehouse(spark, root)
    try:
        with wh.release():
            mart = wh.read("agg_concerts_over_time", "marts")
            wh.write(mart.limit(1), "agg_concerts_over_time", "marts")
            wh.write(mart.withColumn("concert_count", F.raise_error(F.lit("broken off"))),
                     "agg_concerts_by_country", "marts")
    except PySparkException:
        pass
    return Warehouse(spark, root).read("agg_concerts_over_time", "marts")


def _changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fact without the setlists and songs of one quarter and without the second
    copies of records, land these, and rewrite the months that they touch."""
    from ..sources.warehouse import Warehouse
    from .incremental import refresh_fact
    c = _cat(spark, sf_dir)
    late = F.col("event_date").between(F.lit("1996-01-01").cast("date"),
                                       F.lit("1996-03-31").cast("date"))
    raw = {"setlists": c.raw["setlists"], "songs": c.raw["songs"]}
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    # Read twice or more below, so written once.
    quarter = wh.write(raw["setlists"].where(late).select("setlist_id").distinct(), "quarter")
    stg = {"stg_band_mapping": c.stg_band_mapping, "stg_bands": c.stg_bands,
           "stg_albums": c.stg_albums_reviewed}
    stg = {n: wh.write(df, n, "staging") for n, df in stg.items()}
    landed = {"setlists": raw["setlists"].where(late),
              "songs": raw["songs"].join(quarter, "setlist_id", "left_semi")}
    before = {"setlists": raw["setlists"].where(F.coalesce(~late, F.lit(True))),
              "songs": raw["songs"].join(quarter, "setlist_id", "left_anti")}
    from . import marts, staging
    fact = marts.fct_concerts(staging.stg_setlists(before["setlists"]), stg["stg_band_mapping"],
                              stg["stg_bands"], staging.stg_songs(before["songs"]),
                              stg["stg_albums"])
    wh.write_month_partitioned(fact, "fct_concerts", "marts")
    refresh_fact(wh, raw, landed, stg)
    return wh.read("fct_concerts", "marts").drop("event_month_start")


def _loaded_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart over loaded CSV: '' counts as a country there as in the raw tables."""
    from ..sources.csv import load_raw
    from ..sources.landing import write_landing_csv
    from .marts import marts
    from .staging import staging
    landing = write_landing_csv(_cat(spark, sf_dir).raw, scratch_path(spark, "landing"))
    return marts(staging(load_raw(spark, landing)))["agg_festival_seasonality"]


def _rollup_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month states of two landings of the fact, written, merged and rolled up to years."""
    from . import rollups
    fct = _cat(spark, sf_dir).fct_concerts
    second = F.pmod(F.xxhash64("concert_id"), F.lit(2)) == 1
    paths = []
    for landing in (fct.where(~second), fct.where(second)):
        paths.append(scratch_path(spark, "month-states"))
        rollups.month_states(landing).write.parquet(paths[-1])
    states = [spark.read.parquet(p) for p in paths]
    return rollups.distinct_figures(rollups.merge_month_states(*states, by=["event_year"]))


def _rollup_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score states of two landings of albums, merged into medians per subgenre."""
    from . import rollups
    c = _cat(spark, sf_dir)
    second = F.pmod(F.xxhash64("album_id"), F.lit(2)) == 1
    states = [rollups.review_states(part, c.stg_bands) for part in
              (c.stg_albums_reviewed.where(~second), c.stg_albums_reviewed.where(second))]
    return rollups.review_medians(rollups.merge_review_states(*states))


def _interleaved_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.sinks import interleaved
    path = scratch_path(spark, "interleaved")
    interleaved(_cat(spark, sf_dir).dim_bands, "country", "primary_subgenre").write.parquet(path)
    return spark.read.parquet(path).where("primary_subgenre = 'MACHINERY Metal'")


def _loaded_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all songs and, in a file of their own, a line of text for every customer; load the
    songs, set the other lines apart, and count both."""
    from ..sources.landing import write_landing_csv
    from ..sources.rejects import keep_rejects, read_with_rejects
    from ..sources.schemas import RAW_TABLES
    c = _cat(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    write_landing_csv({"songs": c.raw["songs"]}, landing, only=["songs"])
    songs = RAW_TABLES["songs"]
    lines = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat_ws(",", F.lit("s"), "c_name", F.lit("not a number of an encore")).alias("value"))
    header = spark.createDataFrame([(",".join(songs.schema.fieldNames()),)], "value string")
    (header.unionByName(lines).coalesce(1).write.mode("append")
     .text(f"{landing}/{songs.filename}"))
    rows, rejects = read_with_rejects(spark, songs, landing)
    n = keep_rejects(rejects, scratch_path(spark, "rejects"), most=10**9)
    return rows.agg(F.count(F.lit(1)).alias("songs"),
                    F.count_distinct("setlist_id").alias("setlists")).withColumn(
        "rejects", F.lit(n).cast("bigint"))


def _type_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.landing import write_landing_csv
    from ..sources.rejects import type_report
    from ..sources.schemas import RAW_TABLES
    c = _cat(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    write_landing_csv({"songs": c.raw["songs"]}, landing, only=["songs"])
    return type_report(spark, RAW_TABLES["songs"], landing).select(
        "table_name", "column_name", "declared", "n", "misfits")


def _quality_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run whose bands come twice and whose January setlists have no id: nulls
    counted while the tables are written, uniqueness read back."""
    from ..operators.quality import quality_report_written
    from ..sources.warehouse import Warehouse
    c = _cat(spark, sf_dir)
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    nameless = F.when(F.col("event_month") != 1, F.col("setlist_id"))
    tables = {"stg_bands": ("band_id", c.stg_bands.unionByName(c.stg_bands)),
              "stg_setlists": ("setlist_id", c.stg_setlists.withColumn("setlist_id", nameless))}
    written = {n: (wh.write(df, n, "staging", checked=key), key, wh.entry(n, "staging")["nulls"])
               for n, (key, df) in tables.items()}
    return quality_report_written(written)


def _clustered_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.sinks import clustered
    path = scratch_path(spark, "clustered")
    clustered(_cat(spark, sf_dir).dim_venues, "country_code").write.parquet(path)
    return spark.read.parquet(path)


def _stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming.resume import replay_setlists_twice
    _cat(spark, sf_dir)
    return replay_setlists_twice(spark, sf_dir)


QUERIES: dict[str, Query] = {
    # staging
    "stg_bands": _attr("stg_bands"),
    "stg_albums": _attr("stg_albums"),
    "stg_setlists": _attr("stg_setlists"),
    "stg_songs": _attr("stg_songs"),
    "stg_band_mapping": _attr("stg_band_mapping"),
    "stg_labels": _attr("stg_labels"),
    # marts
    "fct_concerts": _attr("fct_concerts"),
    "dim_bands": _attr("dim_bands"),
    "dim_venues": _attr("dim_venues"),
    "concerts_by_country": _attr("concerts_by_country"),
    "concerts_over_time": _attr("concerts_over_time"),
    "country_genre_affinity": _attr("country_genre_affinity"),
    "festival_seasonality": _attr("festival_seasonality"),
    "genre_lifecycle": _attr("genre_lifecycle"),
    "genre_review_distribution": _attr("genre_review_distribution"),
    "genre_touring_intensity": _attr("genre_touring_intensity"),
    "productivity_vs_reviews": _attr("productivity_vs_reviews"),
    "rating_vs_touring": _attr("rating_vs_touring"),
    "subgenre_share_over_time": _attr("subgenre_share_over_time"),
    "top_songs": _attr("top_songs"),
    # dashboard tiles
    "tile_headline_counts": lambda s, d: (lambda c: tiles.headline_counts(
        c.dim_bands, c.fct_concerts, c.top_songs, c.concerts_by_country))(_cat(s, d)),
    "tile_touring_top": lambda s, d: tiles.touring_top(_cat(s, d).genre_touring_intensity),
    "tile_rating_long": lambda s, d: tiles.rating_long(_cat(s, d).rating_vs_touring),
    "tile_concerts_per_year": lambda s, d: tiles.concerts_per_year(_cat(s, d).concerts_over_time),
    "tile_subgenre_share_top10_other": lambda s, d: (lambda c: tiles.subgenre_share_top_other(
        c.genre_touring_intensity, c.subgenre_share_over_time))(_cat(s, d)),
    "tile_country_map": lambda s, d: tiles.country_map(_cat(s, d).concerts_by_country),
    "tile_top_countries": lambda s, d: tiles.top_countries(_cat(s, d).concerts_by_country),
    "tile_top_songs": lambda s, d: tiles.top_songs_tile(_cat(s, d).top_songs),
    "tile_review_genres": lambda s, d: tiles.review_genres(_cat(s, d).genre_review_distribution),
    "tile_review_box": lambda s, d: tiles.review_box(_cat(s, d).genre_review_distribution),
    "tile_review_summary": lambda s, d: tiles.review_summary(_cat(s, d).genre_review_distribution),
    "tile_review_summary_chosen": lambda s, d: tiles.review_summary(
        _cat(s, d).genre_review_distribution, ["MACHINERY Metal", "BUILDING Metal"]),
    "tile_country_specialisation_chosen": lambda s, d: tiles.country_specialisation(
        _cat(s, d).country_genre_affinity, "NATION_3"),
    "tile_genre_countries_lq_chosen": lambda s, d: tiles.genre_countries_lq(
        _cat(s, d).country_genre_affinity, "MACHINERY Metal"),
    "tile_genre_countries_count_chosen": lambda s, d: tiles.genre_countries_count(
        _cat(s, d).country_genre_affinity, "MACHINERY Metal"),
    "tile_country_list": lambda s, d: tiles.distinct_values(_cat(s, d).country_genre_affinity,
                                                            "country"),
    "tile_genre_list": lambda s, d: tiles.distinct_values(_cat(s, d).country_genre_affinity,
                                                          "primary_subgenre"),
    "tile_country_specialisation": lambda s, d: tiles.country_specialisation(
        _cat(s, d).country_genre_affinity),
    "tile_genre_countries_lq": lambda s, d: tiles.genre_countries_lq(
        _cat(s, d).country_genre_affinity),
    "tile_genre_countries_count": lambda s, d: tiles.genre_countries_count(
        _cat(s, d).country_genre_affinity),
    "tile_lifecycle_genres": lambda s, d: tiles.lifecycle_genres(_cat(s, d).genre_lifecycle),
    "tile_lifecycle_cumulative": lambda s, d: tiles.lifecycle_cumulative(
        _cat(s, d).genre_lifecycle),
    # ingest selection
    "ingest_top_bands": lambda s, d: (lambda c: ingest.top_bands_by_reviews(
        c.raw["albums"], c.raw["bands"]))(_cat(s, d)),
    "ingest_band_mapping": lambda s, d: (lambda c: ingest.match_artists(
        ingest.first_bands(c.raw["bands"]), adapters.artist_candidates(s, d)))(_cat(s, d)),
    # The anti join is per band_id like the dedup, so it runs first and the
    # dedup only sorts the bands still to do.
    "ingest_unprocessed": lambda s, d: (lambda c: ingest.first_bands(ingest.unprocessed(
        c.raw["bands"],
        c.raw["band_mapping"].selectExpr("cast(ma_band_id as string) as band_id"))))(_cat(s, d)),
    **{f"load_csv_{name}": _load_csv(name) for name in
       ("bands", "albums", "labels", "setlists", "songs", "band_mapping")},
    "ingest_append_csv": _append_csv("band_mapping"),
    "ingest_append_setlists": _append_csv("setlists"),
    "ingest_append_songs": _append_csv("songs"),
    "ingest_resume": _ingest_resume,
    "ingest_page_rule": _page_rule,
    "loaded_festival_seasonality": _loaded_seasonality,
    "full_run_dim_venues": _full_run(lambda out: out["dim_venues"]),
    "full_run_touring_top": _full_run(
        lambda out: tiles.touring_top(out["agg_genre_touring_intensity"])),
    "full_run_replace": _full_run_replace,
    "full_run_catalog_top_songs": _full_run_catalog(
        lambda spark, db: spark.table(f"{db}marts.agg_top_songs")),
    "full_run_catalog_view": _full_run_catalog(lambda spark, db: spark.sql(
        f"""select country_code, count(*) as setlists, count(distinct artist_mbid) as artists
            from {db}staging.stg_setlists group by country_code""")),
    "fact_changed_months": _changed_months,
    "clustered_read_back": _clustered_read_back,
    "interleaved_read_back": _interleaved_read_back,
    "rollup_year_distincts": _rollup_years,
    "rollup_genre_medians": _rollup_medians,
    "load_with_rejects": _loaded_with_rejects,
    "load_type_report": _type_report,
    "ingest_flatten_setlists": _flatten(0),
    "ingest_flatten_songs": _flatten(1),
    # streaming resume, layout, quality
    "stream_resume_setlists": _stream_resume,
    "stream_ingest_pages_setlists": _stream_pages("setlists"),
    "stream_ingest_pages_songs": _stream_pages("songs"),
    "month_pruned_concerts": _month_pruned,
    "quality_failing_run": _quality_failing,
    "quality_report": lambda s, d: quality.report(_cat(s, d)),
}
