"""Named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame``.  Queries that SQL
can express register the equivalent DuckDB text next to them; the column names
of both sides are identical.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folio.constants import NUMERIC_PATTERN, WHITESPACE_CLASS
from folio.sources.catalog_views import CATALOG_META_SQL, CATALOG_RAW_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------
# DuckDB spellings of the column builders, used to write the oracles.
# ---------------------------------------------------------------------------


def d_norm_text(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '{WHITESPACE_CLASS}+', ' ', 'g'))"


def d_clean_ws(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL "
        f"ELSE trim(regexp_replace({c}, '{WHITESPACE_CLASS}+', ' ', 'g')) END"
    )


def d_isbn(c: str) -> str:
    digits = f"upper(regexp_replace({c}, '[^0-9Xx]', '', 'g'))"
    return f"CASE WHEN length({digits}) IN (10, 13) THEN {digits} END"


def d_year(c: str) -> str:
    num = f"CASE WHEN regexp_matches({c}, '{NUMERIC_PATTERN}') THEN try_cast(trim({c}) AS DOUBLE) END"
    return f"CASE WHEN ({num}) BETWEEN 1500 AND 2035 THEN ({num}) END"


def d_record_id() -> str:
    return (
        "md5(coalesce(title, '') || '|' || coalesce(author_editor, '') || '|' || coalesce(isbn, ''))"
    )


def d_book_key() -> str:
    return "coalesce(isbn, 'NOISBN') || '|' || lower(title)"


CATALOG_CTE = f"catalog_raw AS ({CATALOG_RAW_SQL})"
META_CTE = f"catalog_meta AS ({CATALOG_META_SQL})"

NORMALIZED_CTE = (
    "catalog_norm AS (SELECT row_pos, accession_no, "
    f"{d_norm_text('title')} AS title, {d_norm_text('author_editor')} AS author_editor, "
    f"{d_isbn('isbn')} AS isbn, {d_year('year')} AS year, pages, "
    f"{d_norm_text('class_no_book_no')} AS class_no_book_no, summary FROM catalog_raw)"
)

CLEAN_CTE = (
    "catalog_clean AS (SELECT row_pos, accession_no, title, author_editor, isbn, year, pages, "
    f"class_no_book_no, summary, {d_record_id()} AS record_id FROM ("
    " SELECT *, row_number() OVER (PARTITION BY isbn ORDER BY row_pos) AS rn"
    " FROM catalog_norm WHERE title IS NOT NULL AND isbn IS NOT NULL"
    " UNION ALL"
    " SELECT *, row_number() OVER (PARTITION BY title, author_editor ORDER BY row_pos) AS rn"
    " FROM catalog_norm WHERE title IS NOT NULL AND isbn IS NULL) t WHERE rn = 1)"
)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "

# ---------------------------------------------------------------------------
# Enrichment oracle: metadata facts, one row per key, two-tier lookup.
# ---------------------------------------------------------------------------
_IDS = "from_json(info_json->'$.industryIdentifiers', '[{\"type\":\"VARCHAR\",\"identifier\":\"VARCHAR\"}]')"

META_FACTS_CTE = (
    "meta_facts AS (SELECT meta_pos, isbn_key, title_key, "
    f"{d_clean_ws(chr(40) + 'info_json->>' + chr(39) + '$.title' + chr(39) + chr(41))} AS m_title, "
    "from_json(info_json->'$.authors', '[\"VARCHAR\"]') AS m_authors, "
    f"list_filter({_IDS}, lambda x: x.type IN ('ISBN_13', 'ISBN_10'))[1].identifier AS m_isbn, "
    "info_json->>'$.publishedDate' AS m_year, "
    "from_json(info_json->'$.categories', '[\"VARCHAR\"]') AS m_subjects, "
    f"{d_clean_ws(chr(40) + 'info_json->>' + chr(39) + '$.description' + chr(39) + chr(41))} AS m_summary, "
    "info_json->>'$.publisher' AS m_publisher FROM catalog_meta), "
    "by_isbn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isbn_key ORDER BY meta_pos) AS rn "
    "FROM meta_facts WHERE isbn_key IS NOT NULL) x WHERE rn = 1), "
    "by_title AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title_key ORDER BY meta_pos) AS rn "
    "FROM meta_facts WHERE title_key IS NOT NULL) x WHERE rn = 1)"
)


def _pick(field: str, own: str | None) -> str:
    tail = f" ELSE {own}" if own else ""
    return (
        f"CASE WHEN i.meta_pos IS NOT NULL THEN i.m_{field} "
        f"WHEN t.meta_pos IS NOT NULL THEN t.m_{field}{tail} END AS {field}"
    )


ENRICHED_CTE = (
    "catalog_enriched AS (SELECT c.row_pos, c.record_id, "
    f"{d_book_key().replace('isbn', 'c.isbn').replace('title', 'c.title')} AS book_key, "
    "CASE WHEN i.meta_pos IS NOT NULL OR t.meta_pos IS NOT NULL THEN 'FOUND' ELSE 'MISSING' END AS status, "
    "c.accession_no, c.class_no_book_no, c.pages, "
    f"{_pick('title', 'c.title')}, {_pick('authors', None)}, {_pick('isbn', 'c.isbn')}, "
    f"{_pick('year', None)}, {_pick('subjects', None)}, {_pick('summary', None)}, "
    f"{_pick('publisher', None)}, "
    "CASE WHEN i.meta_pos IS NOT NULL THEN 'isbn' WHEN t.meta_pos IS NOT NULL THEN 'title' END AS match_tier "
    "FROM catalog_clean c LEFT JOIN by_isbn i ON c.isbn = i.isbn_key "
    "LEFT JOIN by_title t ON i.meta_pos IS NULL AND c.title = t.title_key)"
)

ENRICH_CTES = (CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE, META_CTE, META_FACTS_CTE, ENRICHED_CTE)

# Title + author tier (use_author=True): authors of each document, normalised.
BY_TITLE_AUTHOR_CTE = (
    "by_title_author AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title_key, author_key "
    "ORDER BY meta_pos) AS rn FROM (SELECT *, "
    f"{d_norm_text('author')} AS author_key FROM (SELECT *, unnest(m_authors) AS author FROM meta_facts) u) y "
    "WHERE title_key IS NOT NULL AND author_key IS NOT NULL) x WHERE rn = 1)"
)


def _pick3(field: str, own: str | None) -> str:
    tail = f" ELSE {own}" if own else ""
    return (
        f"CASE WHEN i.meta_pos IS NOT NULL THEN i.m_{field} WHEN a.meta_pos IS NOT NULL THEN a.m_{field} "
        f"WHEN t.meta_pos IS NOT NULL THEN t.m_{field}{tail} END AS {field}"
    )


ENRICHED_AUTHOR_CTE = (
    "catalog_enriched_author AS (SELECT c.row_pos, c.record_id, "
    f"{d_book_key().replace('isbn', 'c.isbn').replace('title', 'c.title')} AS book_key, "
    "CASE WHEN i.meta_pos IS NOT NULL OR a.meta_pos IS NOT NULL OR t.meta_pos IS NOT NULL "
    "THEN 'FOUND' ELSE 'MISSING' END AS status, "
    "c.accession_no, c.class_no_book_no, c.pages, "
    f"{_pick3('title', 'c.title')}, {_pick3('authors', None)}, {_pick3('isbn', 'c.isbn')}, "
    f"{_pick3('year', None)}, {_pick3('subjects', None)}, {_pick3('summary', None)}, "
    f"{_pick3('publisher', None)}, "
    "CASE WHEN i.meta_pos IS NOT NULL THEN 'isbn' WHEN a.meta_pos IS NOT NULL THEN 'title_author' "
    "WHEN t.meta_pos IS NOT NULL THEN 'title' END AS match_tier "
    "FROM catalog_clean c LEFT JOIN by_isbn i ON c.isbn = i.isbn_key "
    "LEFT JOIN by_title_author a ON i.meta_pos IS NULL AND c.author_editor IS NOT NULL "
    "AND c.title = a.title_key AND c.author_editor = a.author_key "
    "LEFT JOIN by_title t ON i.meta_pos IS NULL AND c.author_editor IS NULL AND c.title = t.title_key)"
)


def d_strip(c: str) -> str:
    """DuckDB spelling of Python's ``str.strip()``."""
    return f"regexp_replace({c}, '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '', 'g')"


def d_literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def d_display_list(v: str) -> str:
    """DuckDB spelling of P16 on already-cleaned text ``v``."""
    from folio.constants import STRING_LIST_PATTERN

    return (
        f"CASE WHEN regexp_matches({v}, {d_literal(STRING_LIST_PATTERN)}) "
        f"THEN coalesce(array_to_string(from_json({v}, '[\"VARCHAR\"]'), ', '), {v}) ELSE {v} END"
    )
