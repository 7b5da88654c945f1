"""Sinks: overwrite/append tables, month-partitioned and clustered layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv import WRITE_OPTIONS

MONTH_COLUMN = "event_month_start"


def write_append(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append; CSV in the dialect that ``sources.csv`` reads."""
    w = df.write.mode("append").format(fmt)
    if fmt == "csv":
        w = w.options(**WRITE_OPTIONS)
    w.save(path)
    return path


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row: ends a range key, so that a hot value can be split."""
    return F.xxhash64(*df.columns)


def clustered(df: DataFrame, *cols: str, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``cols`` so files carry tight min/max stats.

    The range key ends with a hash of the row: rows that share all of ``cols`` (a
    country with a third of all rows) are spread over as many tasks as their number needs.
    """
    n = partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartitionByRange(int(n), *cols, row_hash(df)).sortWithinPartitions(*cols)


#: Bits of each column's rank in an interleaved key.
RANK_BITS = 8


def ranks(df: DataFrame, col: str, bits: int = RANK_BITS) -> DataFrame:
    """(col, rank): the column's distinct values in 2^bits ranges, in order.

    The ranges are those of a range-partitioned shuffle, so no task sees all values. A session
    of few shuffle partitions gets fewer ranges, but 16 at least.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(1 << bits, max(16, n))
    spread = df.where(F.col(col).isNotNull()).select(col).distinct().repartitionByRange(n, col)
    return spread.select(col, F.spark_partition_id().alias("rank"))


def interleaved(df: DataFrame, *cols: str, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort so that files and row groups are narrow in each of ``cols``.

    The key takes a bit of each column's rank in turn, so a filter on any of the columns
    skips most of the table; ``clustered`` serves the first one only. Nulls rank first. The key
    ends with a hash of the row, as in ``clustered``.
    """
    names = [f"_rank_{k}" for k in range(len(cols))]
    keyed = df
    for c, name in zip(cols, names, strict=True):
        keyed = keyed.join(ranks(df, c).withColumnRenamed("rank", name), c, "left")
    key = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for k, name in enumerate(names):
            one = F.shiftright(F.coalesce(name, F.lit(0)).cast("long"), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(names) + len(names) - 1 - k))
    keyed = keyed.withColumn("_key", key).select(*df.columns, "_key")
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (keyed.repartitionByRange(n, "_key", row_hash(df)).sortWithinPartitions("_key", *cols)
            .drop("_key"))


def month_layout(fct: DataFrame, date_col: str = "event_date",
                 cluster_by: tuple[str, ...] = ("primary_subgenre", "country_code")) -> DataFrame:
    """Add the month column; range-partition and sort by (month, cluster keys).

    Each task then writes few month folders with sorted row groups; a hot month is split.
    """
    df = fct.withColumn(MONTH_COLUMN, F.trunc(F.col(date_col), "month"))
    return clustered(df, MONTH_COLUMN, *cluster_by)


def write_month_partitioned(fct: DataFrame, path: str, date_col: str = "event_date",
                            cluster_by: tuple[str, ...] = ("primary_subgenre", "country_code"),
                            ) -> str:
    """Write the fact partitioned by month of ``date_col``, clustered within."""
    month_layout(fct, date_col, cluster_by).write.mode("overwrite").partitionBy(MONTH_COLUMN) \
        .parquet(path)
    return path


def _month_start(d) -> dt.date:
    d = dt.date.fromisoformat(d) if isinstance(d, str) else d
    return d.replace(day=1)


def concerts_between(spark: SparkSession, path: str, lo, hi,
                     date_col: str = "event_date") -> DataFrame:
    """Rows with ``lo <= date_col <= hi`` from a month-partitioned table.

    The filter on the date column alone does not prune month folders, so the
    same bounds are repeated on the partition column: only the folders of the
    months in range are listed and read.
    """
    lo_m, hi_m = _month_start(lo), _month_start(hi)
    df = spark.read.parquet(path)
    return (df.where(F.col(MONTH_COLUMN).between(F.lit(lo_m), F.lit(hi_m)))
              .where(F.col(date_col).between(F.lit(dt.date.fromisoformat(str(lo))),
                                             F.lit(dt.date.fromisoformat(str(hi)))))
              .drop(MONTH_COLUMN))
