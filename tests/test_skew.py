"""A hot key (a third of all rows) is split, not piled into one task."""

from pyspark.sql import functions as F

from gigframe.plans.marts import fct_concerts
from gigframe.plans.staging import staging
from gigframe.sources.adapters import raw_tables

from conftest import SF_ORACLE


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_artist_partition_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        raw = raw_tables(spark, SF_ORACLE)
        # every third setlist belongs to one artist, mapped to one band
        raw["setlists"] = raw["setlists"].withColumn(
            "artist_mbid", F.when(F.col("setlist_id").cast("bigint") % 3 == 0,
                                  F.lit("mbid-7")).otherwise(F.col("artist_mbid")))
        stg = staging(raw)
        fct = fct_concerts(stg["stg_setlists"], stg["stg_band_mapping"], stg["stg_bands"],
                           stg["stg_songs"], stg["stg_albums"])
        n = fct.count()
        hot = fct.where("ma_band_id = '7'").count()
        assert hot >= n // 3
        fct.collect()
        plan = fct._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skewed" in plan, plan[:3000]
        # the result is whole: every staged setlist of a mapped artist (every fifth mapping
        # points at no band) is there once
        mapped = stg["stg_setlists"].join(
            stg["stg_band_mapping"].where("ma_band_id not like '-%'")
            .withColumnRenamed("sfm_mbid", "artist_mbid"), "artist_mbid")
        assert n == mapped.count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
