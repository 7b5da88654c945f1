"""The full batch run: landed files -> raw -> staging -> marts -> checks.

One Spark application in graph order. Each layer is written once and read
back, so later layers start from files, not from a long lineage: a lost
executor costs at most the layer being written, and every mart reads the
staging tables instead of re-running the staging windows.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from ..operators.hot_keys import apart
from ..session import scratch_path
from ..sources.csv import load_raw
from ..sources.warehouse import Warehouse, stored_bytes
from . import marts as M
from . import quality
from .staging import BY_KEY, staging

# Physical layout. Staging tables are bucketed on the key
# their consumers join or group on, into a power of two of buckets that the
# table's raw size needs, so setlists/songs (setlist_id) and
# bands/albums/mapping (band id) meet bucket by bucket without a shuffle.
STAGING_BUCKETS = {
    "stg_setlists": ("setlist_id",),
    "stg_songs": ("setlist_id",),
    "stg_bands": ("band_id",),
    "stg_albums": ("band_id",),
    "stg_band_mapping": ("ma_band_id",),
}
# Staging tables that meet on their buckets' key: they get as many buckets as the largest needs.
MEET = (("stg_setlists", "stg_songs"), ("stg_bands", "stg_albums", "stg_band_mapping"))
# Bytes of files that a task reads, at most: a file of the raw layer may hold a row in 5 bytes,
# and the tasks that read it sort what they read.
READ_BYTES = 32 * 1024 * 1024
_READ = "spark.sql.files.maxPartitionBytes"
FACT_CLUSTER = ("primary_subgenre", "country_code")
MART_CLUSTER = {
    "dim_bands": ("country", "primary_subgenre"),
    "dim_venues": ("country_code",),
}


def build_all(spark: SparkSession, landing_dir: str, warehouse_root: str,
              check: bool = True, empty_as: str | None = "",
              parallel: int = 4, buckets: int | None = None,
              use_catalog: bool = True, prefix: str = "") -> dict[str, DataFrame]:
    """Build every table; raise if a key check fails. Returns the written marts.

    All tables are published in one commit at the end. If the run fails, at a write or at a
    check, readers keep the tables of the run before.

    Layers become databases ``raw``, ``staging`` and ``marts`` of external
    tables under ``warehouse_root`` (or plain folders there, unbucketed, without
    ``use_catalog``). Tables of one layer do not read each
    other, so up to ``parallel`` of them are written at once from driver
    threads; Spark runs their jobs side by side on the cluster's slots.
    """
    wh = Warehouse(spark, warehouse_root, use_catalog=use_catalog, buckets=buckets,
                   prefix=prefix)
    with _small_reads(spark), wh.release():
        raw = _write_all(wh, load_raw(spark, landing_dir, empty_as), "raw", parallel)
        stg = _write_all(wh, staging(raw), "staging", parallel, bucket=STAGING_BUCKETS,
                         keys_from=raw)
        # Bucketed albums are grouped by band where they are.
        albums = None if use_catalog else _once(M.band_albums(stg["stg_albums"]), "band-albums")
        by_setlist = {n: wh.parts(f"stg_{n}", "staging") for n in ("setlists", "songs")}
        fct = apart(by_setlist, "setlist_id", lambda setlists, songs: M.fct_concerts(
            setlists, stg["stg_band_mapping"], stg["stg_bands"], songs, stg["stg_albums"], albums),
            unique=("setlists",))
        performed = apart(by_setlist, "setlist_id", lambda setlists, songs: M.performances(
            songs, setlists), unique=("setlists",))
        fct = wh.write_month_partitioned(fct, "fct_concerts", "marts", cluster_by=FACT_CLUSTER,
                                         checked=quality.MODEL_KEYS["fct_concerts"]
                                         ).drop("event_month_start")
        rest = {n: df for n, df in M.marts(stg, fct=fct, performed=performed,
                                           albums=albums).items()
                if n != "fct_concerts"}
        out = {"fct_concerts": fct, **_write_all(wh, rest, "marts", parallel, MART_CLUSTER)}
        if check:
            nulls = {name: wh.entry(name, "staging" if name in stg else "marts")["nulls"]
                     for name in quality.MODEL_KEYS}
            quality.check({**stg, **out}, nulls)
    return out


@contextlib.contextmanager
def _small_reads(spark: SparkSession) -> Iterator[None]:
    """Files are read in parts of READ_BYTES at most, in the block."""
    old = spark.conf.get(_READ)
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(old)) > READ_BYTES:
        spark.conf.set(_READ, str(READ_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_READ, old)


def _once(df: DataFrame, name: str) -> DataFrame:
    """Rows that several tables start from, written to a scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_all(wh: Warehouse, tables: dict[str, DataFrame], layer: str, parallel: int,
               cluster: dict | None = None, bucket: dict | None = None,
               keys_from: dict | None = None) -> dict[str, DataFrame]:
    from concurrent.futures import ThreadPoolExecutor

    def write(item):
        name, df = item
        by = (bucket or {}).get(name, ())
        source = name.removeprefix("stg_")
        meet = next((m for m in MEET if name in m), (name,)) if by else ()
        sources = [n.removeprefix("stg_") for n in meet]
        size = max((stored_bytes(wh.spark, wh.current_path(n, "raw")) for n in sources), default=0)
        n_rows = max((wh.entry(n, "raw")["rows"] for n in sources), default=0)
        frequent = keys_from[source] if by and keys_from and by[0] in keys_from[source].columns \
            else None
        columns = (cluster or {}).get(name, ())
        return name, wh.write(df, name, layer, cluster_by=columns, interleave=len(columns) > 1,
                              bucket_by=by, source_bytes=size, keys_from=frequent,
                              checked=quality.MODEL_KEYS.get(name), source_rows=n_rows,
                              plan=BY_KEY.get(name) if frequent is not None else None)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(write, tables.items()))


def main(argv: list[str] | None = None) -> None:
    """``python -m gigframe.plans.full_run <landing_dir> <warehouse_root>``."""
    import argparse

    from ..session import build_session

    p = argparse.ArgumentParser(description="Build raw, staging and mart tables, then check keys.")
    p.add_argument("landing_dir")
    p.add_argument("warehouse_root")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--empty-as-null", action="store_true",
                   help="load empty CSV text cells as NULL instead of ''")
    p.add_argument("--no-check", action="store_true", help="skip the key checks")
    args = p.parse_args(argv)
    spark = build_session(args.master)
    build_all(spark, args.landing_dir, args.warehouse_root, check=not args.no_check,
                 empty_as=None if args.empty_as_null else "")


if __name__ == "__main__":
    main()
