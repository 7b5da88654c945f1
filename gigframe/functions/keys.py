"""Surrogate keys and date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Fixed value: the separator between the fields of a hashed surrogate key.
KEY_SEPARATOR = "|"

# The two event-date spellings accepted from the API pages.
EVENT_DATE_FORMATS = ["dd-MM-yyyy", "yyyy-MM-dd"]


def surrogate_key(*parts) -> Column:
    """Lower-case hex md5 of the parts joined by '|'; NULL if any part is NULL."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(KEY_SEPARATOR))
        pieces.append(_c(p).cast("string"))
    return F.md5(F.concat(*pieces))


def parse_event_date(text) -> Column:
    """Date from API text in either accepted format; NULL when neither fits.

    A text of the first format has its first '-' as third character, one of the second (four
    digits at least) cannot. So only one of them is tried: a format that does not fit
    costs an exception per row inside Spark.
    """
    c = _c(text)
    day_first, year_first = EVENT_DATE_FORMATS
    return (F.when(F.substring(c, 3, 1) == "-", F.try_to_date(c, day_first))
            .otherwise(F.try_to_date(c, year_first)))


def year_of(d) -> Column:
    return F.year(_c(d)).cast("bigint")


def month_of(d) -> Column:
    return F.month(_c(d)).cast("bigint")
