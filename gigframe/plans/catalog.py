"""Lazy builders for staging and marts over one data directory.

``Catalog(spark, sf_dir)`` shapes the driver's tables into raw tables and
hands out staging models and marts on demand, like a model graph whose
``ref`` edges are attribute reads. Nothing runs until an action; the objects
held are lazy plans, not data, so sharing them between queries only saves
rebuilding the same plan on the driver.
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources import adapters
from . import marts as M
from . import staging as S

_CATALOGS: dict[tuple[int, str], "Catalog"] = {}
_LOCK = threading.Lock()


def catalog_for(spark: SparkSession, sf_dir: str) -> "Catalog":
    """One catalog per (session, data directory)."""
    key = (id(spark), sf_dir)
    with _LOCK:
        cat = _CATALOGS.get(key)
        if cat is None or cat.spark is not spark:
            cat = _CATALOGS[key] = Catalog(spark, sf_dir)
        return cat


def forget(spark: SparkSession) -> None:
    """Drop the session's catalogs: later queries plan and read everything anew."""
    with _LOCK:
        for key in [k for k, c in _CATALOGS.items() if c.spark is spark]:
            del _CATALOGS[key]


class _LazyRaw(dict):
    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = self[name] = adapters.RAW_BUILDERS[name](self._spark, self._sf_dir)
        return df


class Catalog:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # raw -----------------------------------------------------------------
    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        """Raw tables, each built on first use."""
        return _LazyRaw(self.spark, self.sf_dir)

    # staging -------------------------------------------------------------
    @cached_property
    def stg_bands(self) -> DataFrame:
        return S.stg_bands(self.raw["bands"])

    @cached_property
    def stg_albums(self) -> DataFrame:
        return S.stg_albums(self.raw["albums"])

    @cached_property
    def stg_albums_reviewed(self) -> DataFrame:
        """stg_albums where review_count > 0, filtered before the dedup."""
        return S.stg_albums(self.raw["albums"], reviewed_only=True)

    @cached_property
    def stg_setlists(self) -> DataFrame:
        return S.stg_setlists(self.raw["setlists"])

    @cached_property
    def stg_songs(self) -> DataFrame:
        return S.stg_songs(self.raw["songs"])

    @cached_property
    def stg_band_mapping(self) -> DataFrame:
        return S.stg_band_mapping(self.raw["band_mapping"])

    @cached_property
    def stg_labels(self) -> DataFrame:
        return S.stg_labels(self.raw["labels"])

    # marts ---------------------------------------------------------------
    @cached_property
    def fct_concerts(self) -> DataFrame:
        return M.fct_concerts(self.stg_setlists, self.stg_band_mapping, self.stg_bands,
                              self.stg_songs, self.stg_albums_reviewed)

    @cached_property
    def dim_bands(self) -> DataFrame:
        return M.dim_bands(self.stg_bands, self.stg_band_mapping, self.stg_albums,
                           self.fct_concerts)

    @cached_property
    def dim_venues(self) -> DataFrame:
        return M.dim_venues(self.stg_setlists)

    @cached_property
    def concerts_by_country(self) -> DataFrame:
        return M.agg_concerts_by_country(self.fct_concerts)

    @cached_property
    def concerts_over_time(self) -> DataFrame:
        return M.agg_concerts_over_time(self.fct_concerts)

    @cached_property
    def country_genre_affinity(self) -> DataFrame:
        return M.agg_country_genre_affinity(self.stg_bands)

    @cached_property
    def festival_seasonality(self) -> DataFrame:
        return M.agg_festival_seasonality(self.fct_concerts)

    @cached_property
    def genre_lifecycle(self) -> DataFrame:
        return M.agg_genre_lifecycle(self.stg_albums, self.stg_bands)

    @cached_property
    def genre_review_distribution(self) -> DataFrame:
        return M.agg_genre_review_distribution(self.stg_albums_reviewed, self.stg_bands)

    @cached_property
    def genre_touring_intensity(self) -> DataFrame:
        return M.agg_genre_touring_intensity(self.fct_concerts)

    @cached_property
    def productivity_vs_reviews(self) -> DataFrame:
        return M.agg_productivity_vs_reviews(self.stg_albums_reviewed)

    @cached_property
    def rating_vs_touring(self) -> DataFrame:
        return M.agg_rating_vs_touring(self.fct_concerts)

    @cached_property
    def subgenre_share_over_time(self) -> DataFrame:
        return M.agg_subgenre_share_over_time(self.fct_concerts)

    @cached_property
    def top_songs(self) -> DataFrame:
        return M.agg_top_songs(self.stg_songs, self.stg_setlists)

    # materialisation ---------------------------------------------------------
    def materialize(self, *names: str) -> "Catalog":
        """Write the named models to the shared checkpoint folder and use them.

        Later tiles and marts that read these models start from the written
        files instead of re-running their lineage (for interactive use over one
        session). A reliable checkpoint, not a local one: it survives the loss
        of the executors that computed it.
        """
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(self.spark)
        for name in names:
            df = getattr(self, name)
            self.__dict__[name] = df.checkpoint(eager=True)
        return self

    # views -----------------------------------------------------------------
    STAGING = ("stg_bands", "stg_albums", "stg_setlists", "stg_songs", "stg_band_mapping",
               "stg_labels")
    MARTS = {"fct_concerts": "fct_concerts", "dim_bands": "dim_bands",
             "dim_venues": "dim_venues", "agg_concerts_by_country": "concerts_by_country",
             "agg_concerts_over_time": "concerts_over_time",
             "agg_country_genre_affinity": "country_genre_affinity",
             "agg_festival_seasonality": "festival_seasonality",
             "agg_genre_lifecycle": "genre_lifecycle",
             "agg_genre_review_distribution": "genre_review_distribution",
             "agg_genre_touring_intensity": "genre_touring_intensity",
             "agg_productivity_vs_reviews": "productivity_vs_reviews",
             "agg_rating_vs_touring": "rating_vs_touring",
             "agg_subgenre_share_over_time": "subgenre_share_over_time",
             "agg_top_songs": "top_songs"}

    def register_views(self, prefix: str = "") -> list[str]:
        """Register staging models and marts as temp views for ``spark.sql``.

        Views stay lazy: a query over them is planned together with the
        models it reads (the staging layer of the original was views too).
        """
        names = []
        for name in self.STAGING:
            getattr(self, name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        for view, attr in self.MARTS.items():
            getattr(self, attr).createOrReplaceTempView(prefix + view)
            names.append(prefix + view)
        return names


class WrittenCatalog:
    """The same attribute names as ``Catalog``, reading the written tables.

    Dashboard tiles then read small pre-aggregated marts instead of
    recomputing them: ``tiles.touring_top(written_catalog(spark)
    .genre_touring_intensity)``.
    """

    def __init__(self, spark: SparkSession, marts_db: str = "marts", staging_db: str = "staging"):
        self.spark = spark
        self._marts_db, self._staging_db = marts_db, staging_db

    def __getattr__(self, attr: str) -> DataFrame:
        if attr.startswith("_"):
            raise AttributeError(attr)
        if attr in Catalog.STAGING:
            return self.spark.table(f"{self._staging_db}.{attr}")
        for table, name in Catalog.MARTS.items():
            if name == attr:
                return self.spark.table(f"{self._marts_db}.{table}")
        raise AttributeError(attr)


def written_catalog(spark: SparkSession, marts_db: str = "marts",
                    staging_db: str = "staging") -> WrittenCatalog:
    return WrittenCatalog(spark, marts_db, staging_db)
