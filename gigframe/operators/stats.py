"""Per-group descriptive statistics, all as mergeable aggregates.

Exact ``percentile`` keeps one counter per distinct value of a group; the
scores it is used on are integers 0-100, so buffers stay tiny however many
rows a group has, and partial aggregation runs map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def describe_by(df: DataFrame, key: str, value: str, decimals: int = 1) -> DataFrame:
    """count, mean, median, sample std, min, max of ``value`` per ``key``.

    Floating results are rounded half-to-even (as pandas does); min and max
    keep the value's type, so integer scores stay integers. std is NULL for a
    single row.
    """
    v = F.col(value)
    agg = df.groupBy(key).agg(
        F.count(v).alias("albums"),
        F.avg(v).alias("mean"),
        F.percentile(v, 0.5).alias("median"),
        F.stddev_samp(v).alias("std_dev"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    integral = isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType,
                                                      T.LongType))
    extremes = [F.col(c) if integral else F.bround(c, decimals).alias(c) for c in ("min", "max")]
    return agg.select(
        key, "albums",
        *[F.bround(c, decimals).alias(c) for c in ("mean", "median", "std_dev")], *extremes)


def box_stats_by(df: DataFrame, key: str, value: str, whisker: float = 1.5) -> DataFrame:
    """Box-plot figures per group: quartiles (linear), fences, whiskers, outliers.

    Rows are first counted per (group, value); scores have few values, so the rest
    works on that small table and the rows are read once. Whiskers reach the most
    extreme values inside the fences; outliers are the rows outside them.
    """
    v, n = F.col(value), F.col("_n")
    counts = (df.where(v.isNotNull()).groupBy(key, value)
              .agg(F.count(F.lit(1)).alias("_n")))
    q = (counts.groupBy(key)
         .agg(F.sum(n).alias("n"),
              F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n).alias("_q"))
         .select(key, "n",
                 F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3")))
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_fence", F.col("q1") - F.lit(whisker) * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + F.lit(whisker) * F.col("iqr")))
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    spans = (counts.join(q.select(key, "lower_fence", "upper_fence"), key).groupBy(key).agg(
        F.min(F.when(inside, v)).cast("double").alias("whisker_low"),
        F.max(F.when(inside, v)).cast("double").alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, n)), F.lit(0)).alias("n_outliers")))
    return q.join(spans, key)
