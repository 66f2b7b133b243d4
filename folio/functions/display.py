"""Read-side value shaping: sentinels, list display, labels, cover URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.constants import COVER_URL_PREFIX, COVER_URL_SUFFIX, SENTINEL_TOKENS, STRING_LIST_PATTERN
from folio.functions.text import strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_sentinel(c: Column | str) -> Column:
    """Strip surrounding whitespace; '', 'null', 'none' (any case) -> NULL."""
    t = strip(_col(c).cast("string"))
    return F.when(~F.lower(t).isin(*SENTINEL_TOKENS), t)


def join_list(c: Column | str, sep: str = ", ") -> Column:
    """Join an array with ', '; a NULL array stays NULL."""
    return F.array_join(_col(c), sep)


def display_list(c: Column | str) -> Column:
    """List text such as '["a", "b"]' or "['a', 'b']" -> 'a, b'.

    Only a list whose items are all quoted strings is joined; any other text
    (plain text, malformed lists, lists of numbers, objects or null/true
    literals) is returned unchanged.
    """
    s = _col(c).cast("string")
    parsed = F.from_json(s, "array<string>")
    return F.when(s.rlike(STRING_LIST_PATTERN), F.coalesce(F.array_join(parsed, ", "), s)).otherwise(s)


def lists_to_json(c: Column | str) -> Column:
    """Serialise an array column as compact JSON text (NULL stays NULL)."""
    return F.to_json(_col(c))


def cover_url(isbn: Column | str) -> Column:
    """Cover image URL for an ISBN; NULL when the ISBN is missing."""
    i = _col(isbn)
    return F.when(i.isNotNull() & (i != ""), F.concat(F.lit(COVER_URL_PREFIX), i, F.lit(COVER_URL_SUFFIX)))


def fill_display(c: Column | str, label: str) -> Column:
    """Default label for a NULL or empty value."""
    return F.coalesce(F.nullif(_col(c).cast("string"), F.lit("")), F.lit(label))


def integer_affinity(c: Column | str) -> Column:
    """Integer value of a text column when it is an integer (also written
    with a zero fraction, like ``200.0``), else NULL."""
    s = F.trim(_col(c).cast("string"))
    return F.when(s.rlike("^[+-]?\\d+(\\.0*)?$"), F.regexp_replace(s, "\\.0*$", "").try_cast("bigint"))
