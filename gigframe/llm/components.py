"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b: long): label is the component's smallest node.

    Alternates two star contractions: every larger neighbour, then every smaller
    one, is hung onto the smallest neighbour. The edges end as one star per
    component after a number of rounds that grows with the logarithm of the
    longest path. Each round is written to the shared folder.
    """
    cur = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(cur)
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        cur = written(small.select("a", F.col("m").alias("b"))
                      .unionByName(small.where("b <> m").select(F.col("b").alias("a"),
                                                                F.col("m").alias("b")))
                      .distinct(), "edges")
        now = _state(cur)
        if now == state:
            break
        state = now
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("label"))
            .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("label")))
            .groupBy("node").agg(F.min("label").alias("label")))
