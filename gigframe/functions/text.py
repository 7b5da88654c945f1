"""Text predicates and parsers (Column -> Column, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The subgenre rule keeps the text before the first "(", then the
# text before the first "/" or ",". A ";" is not a separator.
SUBGENRE_HEAD_PATTERN = r"^([^(]+)"
SUBGENRE_SPLIT_PATTERN = r"^([^/,]+)"

_WS_EDGES = r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$"

_NUMBER_BEGINS = r"^[\x00-\x20\x7f]*[+-]?[0-9.]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def present(x) -> Column:
    """Not NULL and not the empty string (the two spellings of "missing")."""
    c = _c(x)
    return c.isNotNull() & (c != F.lit(""))


def try_bigint(x) -> Column:
    """``try_cast`` to bigint; a text that does not begin like a number is not tried, as inside
    Spark each one that does not parse costs an exception."""
    c = _c(x)
    return F.when(c.rlike(_NUMBER_BEGINS), c.try_cast("bigint"))


def ws_trim(x) -> Column:
    """Strip every Unicode white-space character from both ends.

    Spark's ``trim`` only removes U+0020; warehouse ``trim`` and Python's
    ``str.strip`` remove all white space.
    """
    return F.regexp_replace(_c(x), _WS_EDGES, "")


def extract_or_null(x, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that yields NULL, not '', when nothing matches."""
    return F.nullif(F.regexp_extract(_c(x), pattern, group), F.lit(""))


def parse_subgenre(genre) -> Column:
    """Primary subgenre of a genre string: 'Black Metal/Doom' -> 'Black Metal'.

    NULL when there is no leading text; may be '' for an all-blank head, which
    is why consumers test ``present``.
    """
    head = extract_or_null(genre, SUBGENRE_HEAD_PATTERN)
    return ws_trim(extract_or_null(head, SUBGENRE_SPLIT_PATTERN))


def song_label(song, artist) -> Column:
    """Display label 'song — artist' (NULL if either part is NULL)."""
    return F.concat(_c(song), F.lit(" — "), _c(artist))
