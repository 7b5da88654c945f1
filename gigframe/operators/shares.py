"""Shares of a parent total over already aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parent_total(count_col: str, parent_keys: Sequence[str]) -> Column:
    """Sum of ``count_col`` over the rows sharing ``parent_keys``.

    Use it on aggregated rows (one per group): the window shuffles one row per
    group, not the raw data, so a hot parent costs a handful of rows.
    """
    return F.sum(count_col).over(Window.partitionBy(*parent_keys))


def pct(part, whole, decimals: int = 1) -> Column:
    """``round(part * 100 / whole, decimals)`` in double arithmetic."""
    p = F.col(part) if isinstance(part, str) else part
    w = F.col(whole) if isinstance(whole, str) else whole
    return F.round(p.cast("double") * F.lit(100.0) / w.cast("double"), decimals)


def ratio(num, den) -> Column:
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return n.cast("double") / d.cast("double")


def with_grand_total(df: DataFrame, count_col: str, out: str) -> DataFrame:
    """Attach the one-row grand total of ``count_col`` as column ``out``.

    A one-row aggregate broadcast to every partition, instead of an
    unpartitioned window that would pull all rows into one task.
    """
    total = df.agg(F.sum(count_col).alias(out))
    return df.crossJoin(F.broadcast(total))
