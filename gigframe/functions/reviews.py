"""Parsers for the album 'reviews' text, e.g. '12 (87%)'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, extract_or_null, ws_trim

# The text that means "no reviews", and the two patterns that
# read the count (leading digits) and the average percentage "(NN%)".
NO_REVIEWS = "No Reviews"
REVIEW_COUNT_PATTERN = r"^(\d+)"
REVIEW_PCT_PATTERN = r"\((\d+)%\)"


def _missing(c: Column) -> Column:
    return c.isNull() | (c == F.lit(NO_REVIEWS))


def parse_review_count(reviews) -> Column:
    """NULL or 'No Reviews' -> 0; leading digits -> bigint; no digits -> NULL."""
    c = _c(reviews)
    return (F.when(_missing(c), F.lit(0).cast("bigint"))
            .otherwise(extract_or_null(c, REVIEW_COUNT_PATTERN).cast("bigint")))


def parse_review_pct(reviews) -> Column:
    """NULL or 'No Reviews' -> NULL; else the integer inside '(NN%)'."""
    c = _c(reviews)
    return (F.when(_missing(c), F.lit(None).cast("bigint"))
            .otherwise(extract_or_null(c, REVIEW_PCT_PATTERN).cast("bigint")))


def counter_review_count(reviews) -> Column:
    """Review count as the ingest counter reads it.

    Text before the first '(' with white space stripped, as an integer; NULL
    (ignored by ``sum``) for NULL, '', 'No Reviews' or text that is not an
    integer, e.g. '12 reviews (3%)'.
    """
    c = _c(reviews)
    head = ws_trim(F.split(c, r"\(").getItem(0))
    return (F.when(c.isNull() | (c == F.lit("")) | (c == F.lit(NO_REVIEWS)), F.lit(None))
            .otherwise(head.try_cast("bigint")))
