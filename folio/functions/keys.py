"""Stable identifiers and composite keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.constants import NO_ISBN


def record_id(cols: Sequence[str] = ("title", "author_editor", "isbn")) -> Column:
    """MD5 hex of the columns joined by '|', NULL rendered as ''."""
    parts: list[Column] = []
    for i, name in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return F.md5(F.concat(*parts))


def book_key(isbn: str = "isbn", title: str = "title") -> Column:
    """P8: '<isbn or NOISBN>|<lower(title)>'; an empty ISBN counts as none."""
    return F.concat(
        F.coalesce(F.nullif(F.col(isbn), F.lit("")), F.lit(NO_ISBN)), F.lit("|"), F.lower(F.col(title))
    )
