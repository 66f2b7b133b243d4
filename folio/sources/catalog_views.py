"""Catalogue-shaped views derived from the ``documents`` table.

The given tables carry no library catalogue, so the catalogue jobs run on
views that Spark derives from ``documents``: one catalogue row per document,
with keys made from ranges of doc_id, so that rows, distinct keys and
duplicates all grow in proportion to the table.  The projections inject the defects the
cleaning stage exists for: NULL and blank titles, missing authors, malformed
ISBNs, out-of-range and non-numeric years.

The SQL text is valid unchanged in Spark SQL and DuckDB; the Spark side uses
it as a projection and the DuckDB oracles use it as a leading CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.sources.tables import read_table

# Shared keys: four of every ten documents have one ISBN number, four of every
# six one title number.
ISBN_NUMBER = "CAST(doc_id - doc_id % 10 + CASE WHEN doc_id % 10 IN (1, 2, 3, 4) THEN 1 ELSE doc_id % 10 END AS STRING)"
TITLE_NUMBER = "CAST(doc_id - CASE WHEN doc_id % 6 < 4 THEN doc_id % 6 ELSE 0 END AS STRING)"

# One row per document.  ``row_pos`` is the record's position in the catalogue.
CATALOG_RAW_COLUMNS = [
    "doc_id AS row_pos",
    "CAST(doc_id AS STRING) AS accession_no",
    "CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN '   ' "
    f"ELSE concat('  ', upper(lang), ' ', {TITLE_NUMBER}, '   Volume ') END AS title",
    "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat(source, '  Editor') END AS author_editor",
    "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '12-34' "
    f"WHEN doc_id % 3 = 0 THEN concat('0-', lpad({ISBN_NUMBER}, 8, '0'), '-x') "
    f"ELSE concat('978-', lpad({ISBN_NUMBER}, 10, '0')) END AS isbn",
    "CASE WHEN doc_id % 13 = 0 THEN 'n.d.' ELSE CAST(1450 + n_chars % 640 AS STRING) END AS year",
    "CAST(50 + n_chars % 400 AS STRING) AS pages",
    "lang AS class_no_book_no",
    "text AS summary",
]

# Metadata documents for the tiered lookup: one per document.  Some lookups
# miss because some documents carry keys that no record has (another ISBN
# prefix, a reprint's title).  The keys are pre-normalised: ``isbn_key`` in
# cleaned ISBN form, ``title_key`` in normalised-title form.
CATALOG_META_COLUMNS = [
    "doc_id AS meta_pos",
    "CASE WHEN doc_id % 7 = 3 THEN concat('979', lpad(CAST(doc_id AS STRING), 10, '0')) "
    f"ELSE concat('978', lpad({ISBN_NUMBER}, 10, '0')) END AS isbn_key",
    f"lower(concat(lang, ' ', {TITLE_NUMBER}, CASE WHEN doc_id % 4 = 1 THEN ' reprint' ELSE ' volume' END)) AS title_key",
    "concat('{\"title\":\"  ', lang, '   title ', CAST(doc_id AS STRING), '\",\"authors\":[\"', source, '\",\"', lang, "
    "'\",\"', upper(source), ' Editor', "
    "'\"],\"industryIdentifiers\":[{\"type\":\"OTHER\",\"identifier\":\"o', CAST(doc_id AS STRING), '\"}', "
    "CASE WHEN doc_id % 2 = 0 THEN concat(',{\"type\":\"ISBN_13\",\"identifier\":\"978', lpad(CAST(doc_id AS STRING), 10, '0'), '\"}') ELSE '' END, "
    "'],\"publishedDate\":\"', CAST(1900 + doc_id % 120 AS STRING), '-05\"', "
    "CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat(',\"categories\":[\"', lang, '\"]') END, "
    "',\"description\":\"  ', source, ' notes  on ', lang, '\"', "
    "',\"publisher\":\"', source, '\"}') AS info_json",
]


def _sql(columns: list[str]) -> str:
    return "SELECT " + ", ".join(columns) + " FROM documents"


CATALOG_RAW_SQL = _sql(CATALOG_RAW_COLUMNS)
CATALOG_META_SQL = _sql(CATALOG_META_COLUMNS)


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").selectExpr(*CATALOG_RAW_COLUMNS)


def catalog_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").selectExpr(*CATALOG_META_COLUMNS)
