"""Column builders for text, ISBN and numeric normalisation.

Every builder returns a ``Column`` made of built-in expressions only, so the
work stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.constants import (
    ISBN_LENGTHS,
    NA_TOKENS,
    NUMERIC_PATTERN,
    WHITESPACE_CLASS,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c: ColumnOrName) -> Column:
    """Replace every whitespace run with one space and strip both ends."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_CLASS + "+", " "))


def strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace only."""
    ws = WHITESPACE_CLASS
    return F.regexp_replace(_col(c), f"^{ws}+|{ws}+$", "")


def normalize_text(c: ColumnOrName) -> Column:
    """Strip, lower-case and collapse whitespace; NULL stays NULL."""
    return collapse_whitespace(F.lower(_col(c).cast("string")))


def clean_whitespace(c: ColumnOrName) -> Column:
    """Collapse whitespace without lower-casing; NULL or '' -> NULL.

    A whitespace-only value is not empty before cleaning, so it becomes ''.
    """
    s = _col(c).cast("string")
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(
        collapse_whitespace(s)
    )


def isbn_digits(c: ColumnOrName) -> Column:
    """Keep only [0-9Xx] and upper-case (no length check)."""
    return F.upper(F.regexp_replace(_col(c).cast("string"), "[^0-9Xx]", ""))


def normalize_isbn(c: ColumnOrName) -> Column:
    """P5: digits/X only, upper-cased; NULL unless 10 or 13 characters long.

    Callers should bind the result to a column once; the stripped value is
    referenced twice here and Catalyst does not share ``regexp_replace``.
    """
    digits = isbn_digits(c)
    return F.when(F.length(digits).isin(*ISBN_LENGTHS), digits)


def stringify(c: ColumnOrName) -> Column:
    """Render as text with surrounding whitespace stripped."""
    return strip(_col(c).cast("string"))


def coerce_numeric(c: ColumnOrName, dtype: str | None = None) -> Column:
    """Numeric coercion, anything that is not a plain number -> NULL.

    ``dtype`` is the Spark simple type name of the input when known; numeric
    inputs are only widened to double.  Text must match a plain decimal number
    (so '1999d', 'nan' and 'Infinity' are rejected, unlike a bare cast).
    """
    col = _col(c)
    if dtype in ("double", "float", "int", "bigint", "smallint", "tinyint") or (
        dtype or ""
    ).startswith("decimal"):
        return col.cast("double")
    s = col.cast("string")
    return F.when(s.rlike(NUMERIC_PATTERN), F.trim(s).try_cast("double"))


def null_out_of_range(c: ColumnOrName, lo: float, hi: float) -> Column:
    """Values outside [lo, hi] become NULL; bounds are kept."""
    col = _col(c)
    return F.when(col.between(lo, hi), col)


def null_tokens(c: ColumnOrName, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """A value equal to one of ``tokens`` becomes NULL."""
    col = _col(c)
    return F.when(~col.isin(*list(tokens)), col)
