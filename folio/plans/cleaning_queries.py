"""Registered queries for ingest-side normalisation and the cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import normalize_text
from folio.operators.cleaning import (
    clean,
    dedupe_catalog,
    duplicates,
    keep_first,
    normalize_catalog,
    require,
)
from folio.operators.increments import FirstRows
from folio.plans.registry import (
    CATALOG_CTE,
    CLEAN_CTE,
    NORMALIZED_CTE,
    d_norm_text,
    register,
    with_ctes,
)
from folio.session import reliable_checkpoint, scratch_path
from folio.sources.catalog_views import catalog_raw
from folio.sources.tables import read_table

CATALOG_COLUMNS = (
    "row_pos, accession_no, title, author_editor, isbn, year, pages, class_no_book_no, summary"
)


def clean_catalog_df(spark, sf_dir, columns=None):
    """The clean catalogue; with ``columns``, of those raw columns only.

    Keep-first carries every column through its aggregate and shuffle, so a
    query that does not return the texts leaves ``summary`` out here."""
    raw = catalog_raw(spark, sf_dir)
    return clean(raw.select("row_pos", *columns) if columns else raw)


#: What decides and identifies a record.
KEY_COLUMNS = ("title", "author_editor", "isbn")


@register(
    "clean_catalog",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE) + "SELECT * FROM catalog_clean",
)
def q_clean_catalog(spark, sf_dir):
    """X3 flagship: catalogue -> normalised, validated, deduplicated, with record ids."""
    return clean_catalog_df(spark, sf_dir)


@register(
    "normalize_catalog",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE) + f"SELECT {CATALOG_COLUMNS} FROM catalog_norm",
)
def q_normalize_catalog(spark, sf_dir):
    """P3, P5, P2, P6 over every catalogue row."""
    return normalize_catalog(catalog_raw(spark, sf_dir)).select(*CATALOG_COLUMNS.split(", "))


@register(
    "normalize_documents",
    "SELECT doc_id, md5(" + d_norm_text("text") + ") AS text_md5, "
    "length(" + d_norm_text("text") + ") AS n_norm_chars FROM documents",
)
def q_normalize_documents(spark, sf_dir):
    """P3 over whole document texts (all Unicode whitespace), hashed for compact output."""
    norm = read_table(spark, sf_dir, "documents", spread=True).select("doc_id", normalize_text("text").alias("t"))
    return norm.select(
        "doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("n_norm_chars")
    )


@register(
    "keep_first_isbn",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE)
    + f"SELECT {CATALOG_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY isbn ORDER BY row_pos) AS rn "
    "FROM catalog_norm WHERE title IS NOT NULL AND isbn IS NOT NULL) t WHERE rn = 1",
)
def q_keep_first_isbn(spark, sf_dir):
    """First row per ISBN among titled rows that have one."""
    norm = require(normalize_catalog(catalog_raw(spark, sf_dir))).where(F.col("isbn").isNotNull())
    return keep_first(norm, ["isbn"]).select(*CATALOG_COLUMNS.split(", "))


@register(
    "keep_first_title_author",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE)
    + f"SELECT {CATALOG_COLUMNS} FROM (SELECT *, row_number() OVER "
    "(PARTITION BY title, author_editor ORDER BY row_pos) AS rn "
    "FROM catalog_norm WHERE title IS NOT NULL AND isbn IS NULL) t WHERE rn = 1",
)
def q_keep_first_title_author(spark, sf_dir):
    """First row per (title, author) among rows without ISBN; NULL authors group together."""
    norm = require(normalize_catalog(catalog_raw(spark, sf_dir))).where(F.col("isbn").isNull())
    return keep_first(norm, ["title", "author_editor"]).select(*CATALOG_COLUMNS.split(", "))


@register(
    "dedupe_catalog",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE)
    + f"SELECT {CATALOG_COLUMNS} FROM catalog_clean",
)
def q_dedupe_catalog(spark, sf_dir):
    """D3: the two-tier dedupe (without the record id)."""
    norm = require(normalize_catalog(catalog_raw(spark, sf_dir)))
    return dedupe_catalog(norm).select(*CATALOG_COLUMNS.split(", "))


@register(
    "duplicate_titles",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE)
    + "SELECT row_pos, title, record_id FROM (SELECT row_pos, title, record_id, "
    "row_number() OVER (PARTITION BY title ORDER BY row_pos) AS rn FROM catalog_clean) t WHERE rn > 1",
)
def q_duplicate_titles(spark, sf_dir):
    """Second and later occurrences of a title in the clean table."""
    return duplicates(clean_catalog_df(spark, sf_dir, KEY_COLUMNS).select("row_pos", "title", "record_id"), "title")


@register(
    "keep_first_lineitem",
    "SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM ("
    "SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn "
    "FROM lineitem) t WHERE rn = 1",
)
def q_keep_first_lineitem(spark, sf_dir):
    """D1 at volume: the earliest shipped line of every part over all of lineitem."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return keep_first(li, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])


#: Deliveries of the incremental queries; they arrive from the last to the first.
DELIVERIES = 4


@register(
    "dedupe_catalog_increments",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE)
    + f"SELECT {CATALOG_COLUMNS} FROM catalog_clean",
)
def q_dedupe_catalog_increments(spark, sf_dir):
    """D1-D3 over deliveries: every catalogue row arrives in one of four,
    dealt by a hash, so that later rows come before earlier ones; after a compaction halfway the stored table equals
    one two-tier dedupe over everything."""
    norm = require(normalize_catalog(catalog_raw(spark, sf_dir)))
    no_isbn = F.col("isbn").isNull()
    tiers = {"d_isbn": F.col("isbn"), "d_title": F.when(no_isbn, F.col("title")), "d_author": F.when(no_isbn, F.col("author_editor"))}
    norm = reliable_checkpoint(norm.withColumns(tiers), "deliveries")
    table = FirstRows(spark, scratch_path(spark, "first-rows"), list(tiers), buckets=8)
    for i in reversed(range(DELIVERIES)):
        table.deliver(norm.where(F.pmod(F.xxhash64("row_pos"), F.lit(DELIVERIES)) == i), f"d{i}")
        if i == DELIVERIES // 2:
            table.compact()
    return table.rows().select(*CATALOG_COLUMNS.split(", "))
