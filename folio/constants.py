"""Fixed values that must equal the catalogue contract for right results.

Everything here is data, not logic: column names, token lists, bounds and
templates.  Operators import these instead of repeating literals.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — raw catalogue header -> canonical column name, in file order.
# ---------------------------------------------------------------------------
COLUMN_MAPPING: dict[str, str] = {
    "Date": "date",
    "Acc. No.": "accession_no",
    "Title": "title",
    "Author/Editor": "author_editor",
    "Ed./Vol.": "edition_volume",
    "Place & Publisher": "place_publisher",
    "ISBN": "isbn",
    "Year": "year",
    "Page(s)": "pages",
    "Source": "source",
    "Class No./Book No.": "class_no_book_no",
}
CANONICAL_COLUMNS: list[str] = list(COLUMN_MAPPING.values())

# FIXED VALUES — free-text columns that cleaning lower-cases and re-spaces.
TEXT_COLUMNS: list[str] = [
    "title",
    "author_editor",
    "edition_volume",
    "place_publisher",
    "source",
    "class_no_book_no",
]

# FIXED VALUES — strings a pandas CSV read treats as missing by default
# (public pandas `na_values` defaults).  A field equal to one of these is NULL.
NA_TOKENS: list[str] = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# FIXED VALUES — publication-year sanity bounds (inclusive).
YEAR_MIN = 1500
YEAR_MAX = 2035

# FIXED VALUES — valid ISBN lengths after stripping to [0-9Xx].
ISBN_LENGTHS = (10, 13)

# FIXED VALUES — book key placeholder for records without an ISBN.
NO_ISBN = "NOISBN"

# FIXED VALUES — metadata identifier types accepted as an ISBN, in priority order
# of appearance (the first matching element of the array wins).
ISBN_IDENTIFIER_TYPES = ("ISBN_13", "ISBN_10")

# FIXED VALUES — enrichment outcome labels.
STATUS_FOUND = "FOUND"
STATUS_MISSING = "MISSING"

# FIXED VALUES — enriched record columns, in output order.
ENRICHED_COLUMNS: list[str] = [
    "record_id",
    "book_key",
    "status",
    "accession_no",
    "class_no_book_no",
    "pages",
    "title",
    "authors",
    "isbn",
    "year",
    "subjects",
    "summary",
    "publisher",
]
LIST_COLUMNS: list[str] = ["authors", "subjects"]

# FIXED VALUES — frozen feature table columns, in order.
FEATURE_COLUMNS: list[str] = [
    "record_id",
    "title",
    "class_no_book_no",
    "intent",
    "depth",
    "publisher",
    "pages",
]

# FIXED VALUES — text columns assembled for semantic encoding, priority order.
EMBED_COLUMNS: list[str] = [
    "summary",
    "subjects",
    "title",
    "publisher",
    "class_no_book_no",
]

# FIXED VALUES — browse search is allowed on these columns only.
SEARCHABLE_FIELDS: tuple[str, ...] = ("title", "authors", "publisher")

# FIXED VALUES — sentinel texts that mean "no value" on the read side.
SENTINEL_TOKENS = ("", "null", "none")

# FIXED VALUES — paging and retrieval defaults.
DEFAULT_PAGE_SIZE = 10
UI_PAGE_SIZE = 5
RECOMMEND_PAGE_SIZE = 10
DEFAULT_TOP_K = 5

# FIXED VALUES — display labels and cover image URL template.
NOT_AVAILABLE = "_Not available_"
UNTITLED = "Untitled"
COVER_URL_PREFIX = "https://covers.openlibrary.org/b/isbn/"
COVER_URL_SUFFIX = "-L.jpg"

# FIXED VALUES — similarity metric name recorded in index metadata.
INDEX_METRIC = "cosine"

# FIXED VALUES — metadata document schema (DDL) for `from_json`.
META_SCHEMA_DDL = (
    "title STRING, authors ARRAY<STRING>, "
    "industryIdentifiers ARRAY<STRUCT<type: STRING, identifier: STRING>>, "
    "publishedDate STRING, categories ARRAY<STRING>, description STRING, "
    "publisher STRING"
)

# FIXED VALUES — characters Python's str.isspace() accepts (Unicode White_Space
# plus the four ASCII information separators U+001C..U+001F).  Written with
# \x{...} escapes so the same class works in Java regex and RE2.
WHITESPACE_CLASS = (
    "[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}"
    "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

# FIXED VALUES — a plain decimal number as pandas.to_numeric accepts it.
NUMERIC_PATTERN = "^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$"

# FIXED VALUES — token splitter and bucket count for the hashed bag of words.
TOKEN_SPLIT_PATTERN = "[^\\p{L}0-9]+"
HASH_BUCKETS = 256

# FIXED VALUES — a bracketed list whose items are all quoted string literals
# (double or single quotes); only such list text is displayed joined.
STRING_LIST_PATTERN = (
    "^\\[\\s*(?:(?:\"(?:[^\"\\\\]|\\\\.)*\"|'(?:[^'\\\\]|\\\\.)*')\\s*"
    "(?:,\\s*(?:\"(?:[^\"\\\\]|\\\\.)*\"|'(?:[^'\\\\]|\\\\.)*')\\s*)*)?\\]$"
)
