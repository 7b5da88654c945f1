"""Column -> Column functions. No Python UDFs: all stay in whole-stage codegen."""

from .buckets import month_abbrev, productivity_bucket, touring_bucket
from .keys import month_of, parse_event_date, surrogate_key, year_of
from .reviews import counter_review_count, parse_review_count, parse_review_pct
from .text import extract_or_null, parse_subgenre, present, song_label, try_bigint, ws_trim

__all__ = [
    "counter_review_count", "extract_or_null", "month_abbrev", "month_of",
    "parse_event_date", "parse_review_count", "parse_review_pct", "parse_subgenre",
    "present", "productivity_bucket", "song_label", "surrogate_key", "touring_bucket",
    "try_bigint", "ws_trim", "year_of",
]
