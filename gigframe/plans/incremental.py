"""Bring the written fact up to date after a landing, months that it touches only.

A landing brings new setlists and songs, or sends known ones again. The concerts of these
setlists are computed anew from all their raw rows, so the keep-first rules see every
copy. The months they are in now, and the months they were in before, are written anew:
their other concerts are copied from the fact. All other months keep their files. The
new months replace the old ones in one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import MONTH_COLUMN
from ..sources.warehouse import NO_MONTH, Warehouse
from . import marts as M
from . import staging as S
from .full_run import FACT_CLUSTER


def landed_ids(setlists: DataFrame, songs: DataFrame) -> DataFrame:
    """setlist_id of every setlist that a landing sends or has songs for; no null."""
    return (setlists.select("setlist_id").unionByName(songs.select("setlist_id"))
            .where("setlist_id is not null").distinct())


def concerts_of(ids: DataFrame, raw: dict[str, DataFrame], mapping: DataFrame, bands: DataFrame,
                albums: DataFrame) -> DataFrame:
    """The fact's rows of the given setlists, from all raw setlists and songs."""
    setlists = S.stg_setlists(raw["setlists"].join(ids, "setlist_id", "left_semi"))
    songs = S.stg_songs(raw["songs"].join(ids, "setlist_id", "left_semi"))
    return M.fct_concerts(setlists, mapping, bands, songs, albums)


def _months(rows: DataFrame) -> set[str]:
    found = rows.select(F.col(MONTH_COLUMN).cast("string").alias("m")).distinct().collect()
    return {NO_MONTH if r["m"] is None else r["m"] for r in found}  # as many as there are months


def refresh_fact(wh: Warehouse, raw: dict[str, DataFrame], landed: dict[str, DataFrame],
                 stg: dict[str, DataFrame], name: str = "fct_concerts",
                 layer: str = "marts") -> list[str]:
    """Replace the months of the written fact that a landing touches; returns them.

    ``raw`` has all setlists and songs, those of the landing included; ``landed`` those of the
    landing alone; ``stg`` the staged mapping, bands and albums. Setlists without an id make
    one concert together, whose keep-first row can come from any landing: if a landing has
    some, it is computed anew too. Bands, albums and mappings are taken as they
    were when the fact was built; after a change there, build it anew.
    """
    spark = wh.spark
    ids = landed_ids(landed["setlists"], landed["songs"])
    fresh = concerts_of(ids, raw, stg["stg_band_mapping"], stg["stg_bands"], stg["stg_albums"])
    nameless = not landed["setlists"].where("setlist_id is null").isEmpty()
    if nameless:
        fresh = fresh.unionByName(M.fct_concerts(
            S.stg_setlists(raw["setlists"].where("setlist_id is null")), stg["stg_band_mapping"],
            stg["stg_bands"], S.stg_songs(raw["songs"].limit(0)), stg["stg_albums"]))
    fresh = fresh.withColumn(MONTH_COLUMN, F.trunc("event_date", "month"))
    fresh = _kept(wh, fresh, "fresh")
    ids = _kept(wh, ids, "ids")
    old = wh.read(name, layer)
    gone = old.join(ids, old.concert_id == ids.setlist_id, "left_semi")
    if nameless:
        gone = gone.unionByName(old.where("concert_id is null"))
    months = sorted(_months(fresh) | _months(gone))
    if not months:
        return []
    days = [m for m in months if m != NO_MONTH]
    touched = F.coalesce(F.col(MONTH_COLUMN).cast("string").isin(days), F.lit(NO_MONTH in months))
    rest = old.where(touched).join(ids, old.concert_id == ids.setlist_id, "left_anti")
    if nameless:
        rest = rest.where("concert_id is not null")
    rows = rest.unionByName(fresh.select(rest.columns)).drop(MONTH_COLUMN)
    wh.replace_months(rows, months, name, layer, cluster_by=FACT_CLUSTER)
    return months


def _kept(wh: Warehouse, df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder: read twice, and a lost executor costs no recomputation."""
    from ..session import scratch_path
    path = scratch_path(wh.spark, name)
    df.write.parquet(path)
    return wh.spark.read.parquet(path)
