"""Bucketing and label functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Touring buckets by concert count (inclusive bounds); anything
# else, NULL included, is '100+'.
TOURING_BUCKETS = [(0, 5, "0-5"), (6, 20, "6-20"), (21, 50, "21-50"), (51, 100, "51-100")]
TOURING_ELSE = "100+"

# Productivity buckets by album count; anything else is '20+ albums'.
PRODUCTIVITY_BUCKETS = [(1, 2, "1-2 albums"), (3, 5, "3-5 albums"), (6, 10, "6-10 albums"),
                        (11, 20, "11-20 albums")]
PRODUCTIVITY_ELSE = "20+ albums"

# English short month names, January first.
MONTH_ABBREVIATIONS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                       "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _range_buckets(c: Column, buckets, default: str) -> Column:
    expr = None
    for lo, hi, label in buckets:
        cond = c.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def touring_bucket(concerts) -> Column:
    return _range_buckets(_c(concerts), TOURING_BUCKETS, TOURING_ELSE)


def productivity_bucket(albums) -> Column:
    return _range_buckets(_c(albums), PRODUCTIVITY_BUCKETS, PRODUCTIVITY_ELSE)


def month_abbrev(month) -> Column:
    """1 -> 'Jan' ... 12 -> 'Dec'; anything else -> NULL (locale independent)."""
    c = _c(month)
    expr = None
    for i, name in enumerate(MONTH_ABBREVIATIONS, start=1):
        expr = F.when(c == i, F.lit(name)) if expr is None else expr.when(c == i, F.lit(name))
    return expr
