"""Column-level builders (pure built-in Spark expressions)."""

from folio.functions.display import (
    clean_sentinel,
    cover_url,
    display_list,
    fill_display,
    integer_affinity,
    join_list,
    lists_to_json,
)
from folio.functions.keys import book_key, record_id
from folio.functions.text import (
    clean_whitespace,
    coerce_numeric,
    collapse_whitespace,
    isbn_digits,
    normalize_isbn,
    normalize_text,
    null_out_of_range,
    null_tokens,
    stringify,
    strip,
)
from folio.functions.vectors import dot, l2_norm, l2_normalize, round_vector, squared_norm

__all__ = [
    "book_key",
    "clean_sentinel",
    "clean_whitespace",
    "coerce_numeric",
    "collapse_whitespace",
    "cover_url",
    "display_list",
    "dot",
    "fill_display",
    "integer_affinity",
    "isbn_digits",
    "join_list",
    "l2_norm",
    "l2_normalize",
    "lists_to_json",
    "normalize_isbn",
    "normalize_text",
    "null_out_of_range",
    "null_tokens",
    "record_id",
    "round_vector",
    "squared_norm",
    "stringify",
    "strip",
]
