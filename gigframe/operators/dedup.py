"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first under ``order``.

    Written as ``row_number() ... = 1`` so Catalyst plans a partial
    WindowGroupLimit before the shuffle: every map task already drops all but
    its own first row per key, so a key holding a third of the rows costs one
    row in the exchange, not a third of the table. ``order`` should break all
    ties on the output columns, or the pick is arbitrary.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def asc_first(*cols: str) -> list[Column]:
    """Ascending, NULLs first (the warehouse default) for each column."""
    return [F.col(c).asc_nulls_first() for c in cols]
