"""Registered queries: enrichment, store, features and stage statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.constants import LIST_COLUMNS
from folio.functions import (
    clean_sentinel,
    cover_url,
    display_list,
    fill_display,
    integer_affinity,
    join_list,
    lists_to_json,
)
from folio.constants import NOT_AVAILABLE, UNTITLED
from folio.operators.cleaning import keep_first
from folio.operators.enrichment import enrich, extract_metadata, parse_metadata, remaining
from folio.operators.features import features, flatten_struct
from folio.operators.quality import (
    by_status,
    coverage,
    enrichment_stats,
    profile,
    removed,
    stage_summary,
    store_stats,
)
from folio.operators.sketches import SketchTable, error
from folio.operators.store import insert_or_ignore, to_store_rows
from folio.operators.store_filter import append_filtered
from folio.plans.cleaning_queries import KEY_COLUMNS, clean_catalog_df
from folio.plans.raw_csv import ingested_catalog
from folio.session import reliable_checkpoint, scratch_path
from folio.plans.registry import (
    CATALOG_CTE,
    CLEAN_CTE,
    ENRICH_CTES,
    META_CTE,
    META_FACTS_CTE,
    NORMALIZED_CTE,
    BY_TITLE_AUTHOR_CTE,
    ENRICHED_AUTHOR_CTE,
    d_book_key,
    d_display_list,
    d_strip,
    register,
    with_ctes,
)
from folio.sources.catalog_views import catalog_meta, catalog_raw
from folio.sources.tables import read_table

ENRICHED = "row_pos, record_id, book_key, status, accession_no, class_no_book_no, pages, title, " \
    "authors, isbn, year, subjects, summary, publisher, match_tier"


#: Raw columns the enrichment reads (its summary comes from the metadata).
ENRICH_COLUMNS = (*KEY_COLUMNS, "accession_no", "class_no_book_no", "pages")


def enriched_df(spark, sf_dir):
    return enrich(clean_catalog_df(spark, sf_dir, ENRICH_COLUMNS), catalog_meta(spark, sf_dir), carry=("row_pos",))


def enriched_table(spark, sf_dir):
    """The enriched records written once to the shared checkpoint folder, for
    queries that read them more than once (a stage table: later branches read
    it instead of re-running the enrichment, and lineage is cut there)."""
    return reliable_checkpoint(enriched_df(spark, sf_dir), "enriched")


# "Already stored / already processed" in the store and resume queries: the
# English-language records, loaded by an earlier run.
EARLIER_RUN = "class_no_book_no = 'en'"


@register(
    "extract_metadata",
    with_ctes(META_CTE, META_FACTS_CTE)
    + "SELECT meta_pos, m_title AS title, m_authors AS authors, array_to_string(m_authors, ', ') AS authors_text, "
    "m_isbn AS isbn, m_year AS year, m_subjects AS subjects, array_to_string(m_subjects, ', ') AS subjects_text, "
    "m_summary AS summary, m_publisher AS publisher FROM meta_facts",
)
def q_extract_metadata(spark, sf_dir):
    """Flatten every metadata document."""
    facts = extract_metadata(parse_metadata(catalog_meta(spark, sf_dir)))
    return facts.select(
        "meta_pos",
        F.col("meta_title").alias("title"),
        F.col("meta_authors").alias("authors"),
        join_list("meta_authors").alias("authors_text"),
        F.col("meta_isbn").alias("isbn"),
        F.col("meta_year").alias("year"),
        F.col("meta_subjects").alias("subjects"),
        join_list("meta_subjects").alias("subjects_text"),
        F.col("meta_summary").alias("summary"),
        F.col("meta_publisher").alias("publisher"),
    )


@register("tiered_enrichment", with_ctes(*ENRICH_CTES) + f"SELECT {ENRICHED} FROM catalog_enriched")
def q_tiered_enrichment(spark, sf_dir):
    """ISBN tier, then title tier on the misses, shaped per outcome."""
    return enriched_df(spark, sf_dir)


@register(
    "tiered_enrichment_by_author",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE, META_CTE, META_FACTS_CTE, BY_TITLE_AUTHOR_CTE, ENRICHED_AUTHOR_CTE)
    + f"SELECT {ENRICHED} FROM catalog_enriched_author",
)
def q_tiered_enrichment_by_author(spark, sf_dir):
    """J3 with title + author: records with an author must match a listed
    (normalised) author of a same-title document; records without one fall
    back to the title alone."""
    return enrich(clean_catalog_df(spark, sf_dir, ENRICH_COLUMNS), catalog_meta(spark, sf_dir), carry=("row_pos",), use_author=True)


@register(
    "enrichment_stats",
    with_ctes(*ENRICH_CTES)
    + "SELECT count(*) AS total_processed, count(*) FILTER (WHERE status = 'FOUND') AS found_books, "
    "count(*) FILTER (WHERE status = 'MISSING') AS missing_books, "
    "round(100.0::DOUBLE * avg(CASE WHEN status = 'FOUND' THEN 1.0 ELSE 0.0 END), 2) AS success_rate_pct "
    "FROM catalog_enriched",
)
def q_enrichment_stats(spark, sf_dir):
    """A4."""
    return enrichment_stats(enriched_df(spark, sf_dir))


@register(
    "found_coverage",
    with_ctes(*ENRICH_CTES)
    + "SELECT count(*) AS found_books, count(authors) AS authors_available, count(subjects) AS subjects_available, "
    "count(summary) AS summary_available, count(publisher) AS publisher_available "
    "FROM catalog_enriched WHERE status = 'FOUND'",
)
def q_found_coverage(spark, sf_dir):
    """F4 + A5: field coverage among FOUND records (the published coverage table)."""
    found = by_status(enriched_df(spark, sf_dir), "FOUND")
    fields = ["authors", "subjects", "summary", "publisher"]
    return found.agg(F.count(F.lit(1)).alias("found_books"), *[F.count(c).alias(f"{c}_available") for c in fields])


@register(
    "coverage",
    with_ctes(*ENRICH_CTES)
    + "SELECT count(authors) AS authors_available, count(subjects) AS subjects_available, "
    "count(summary) AS summary_available, count(publisher) AS publisher_available FROM catalog_enriched",
)
def q_coverage(spark, sf_dir):
    """A5."""
    return coverage(enriched_df(spark, sf_dir), ["authors", "subjects", "summary", "publisher"])


@register(
    "resume_remaining",
    with_ctes(*ENRICH_CTES)
    + f"SELECT c.row_pos, c.record_id, {d_book_key().replace('isbn', 'c.isbn').replace('title', 'c.title')} AS book_key "
    "FROM catalog_clean c WHERE NOT EXISTS (SELECT 1 FROM catalog_enriched e "
    f"WHERE e.{EARLIER_RUN} AND e.book_key = "
    f"{d_book_key().replace('isbn', 'c.isbn').replace('title', 'c.title')})",
)
def q_resume_remaining(spark, sf_dir):
    """Records still to enrich after an earlier run processed the English ones."""
    from folio.functions import book_key

    clean = clean_catalog_df(spark, sf_dir, KEY_COLUMNS).withColumn("book_key", book_key())
    done = enriched_df(spark, sf_dir).where(EARLIER_RUN).select("book_key")
    return remaining(clean, done).select("row_pos", "record_id", "book_key")


STORED = (
    "row_pos, record_id, book_key, status, accession_no, class_no_book_no, pages, title, "
    "CAST(to_json(authors) AS VARCHAR) AS authors, isbn, year, CAST(to_json(subjects) AS VARCHAR) AS subjects, "
    "summary, publisher, CASE WHEN regexp_matches(trim(pages), '^[+-]?\\d+$') THEN try_cast(trim(pages) AS BIGINT) END AS pages_int"
)


@register(
    "store_insert_or_ignore",
    with_ctes(*ENRICH_CTES)
    + ", existing AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_key ORDER BY row_pos) AS rn "
    f"FROM catalog_enriched WHERE {EARLIER_RUN}) x WHERE rn = 1), "
    "incoming AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_key ORDER BY row_pos) AS rn "
    "FROM catalog_enriched) x WHERE rn = 1) "
    f"SELECT {STORED}, 'existing' AS origin FROM existing UNION ALL "
    f"SELECT {STORED}, 'inserted' AS origin FROM incoming i WHERE NOT EXISTS "
    "(SELECT 1 FROM existing e WHERE e.book_key = i.book_key)",
)
def q_store_insert_or_ignore(spark, sf_dir):
    """The stored table after inserting all records into
    a store that already holds the English ones."""
    enriched = enriched_table(spark, sf_dir)
    existing = to_store_rows(keep_first(enriched.where(EARLIER_RUN), ["book_key"]), keep=["row_pos"])
    accepted = insert_or_ignore(to_store_rows(enriched, keep=["row_pos"]), existing)
    return existing.withColumn("origin", F.lit("existing")).unionByName(
        accepted.withColumn("origin", F.lit("inserted"))
    )


@register(
    "store_insert_filtered",
    with_ctes(*ENRICH_CTES)
    + ", existing AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_key ORDER BY row_pos) AS rn "
    f"FROM catalog_enriched WHERE {EARLIER_RUN}) x WHERE rn = 1), "
    "incoming AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_key ORDER BY row_pos) AS rn "
    "FROM catalog_enriched) x WHERE rn = 1) "
    f"SELECT {STORED} FROM existing UNION ALL "
    f"SELECT {STORED} FROM incoming i WHERE NOT EXISTS "
    "(SELECT 1 FROM existing e WHERE e.book_key = i.book_key)",
)
def q_store_insert_filtered(spark, sf_dir):
    """S12, J4 with the key filter: the English records are stored, then all
    records are inserted; only files that may hold one of their keys are read."""
    enriched = enriched_table(spark, sf_dir)
    path = scratch_path(spark, "filtered-store")
    append_filtered(spark, to_store_rows(enriched.where(EARLIER_RUN), keep=["row_pos"]), path)
    return append_filtered(spark, to_store_rows(enriched, keep=["row_pos"]), path)


@register(
    "features",
    with_ctes(*ENRICH_CTES)
    + "SELECT record_id, title, class_no_book_no, CAST(NULL AS VARCHAR) AS intent, "
    "CAST(NULL AS VARCHAR) AS depth, publisher, pages FROM catalog_enriched",
)
def q_features(spark, sf_dir):
    """X5 (P11-P13, S3): frozen feature table; signals absent -> NULL."""
    return features(enriched_df(spark, sf_dir))


@register(
    "props_field",
    "SELECT event_id, event_type, CAST(props->>'$.k' AS INT) AS k FROM events",
)
def q_props_field(spark, sf_dir):
    """P12 on JSON text: extract ``$.k`` from every event's props."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return flatten_struct(ev, "props", ["k"], "int").select("event_id", "event_type", "k")


@register(
    "lists_to_json",
    with_ctes(*ENRICH_CTES)
    + "SELECT record_id, CAST(to_json(authors) AS VARCHAR) AS authors_json, "
    "CAST(to_json(subjects) AS VARCHAR) AS subjects_json FROM catalog_enriched",
)
def q_lists_to_json(spark, sf_dir):
    """P14."""
    e = enriched_df(spark, sf_dir)
    return e.select("record_id", lists_to_json("authors").alias("authors_json"),
                    lists_to_json("subjects").alias("subjects_json"))


# Legacy stored text: list columns written with json.dumps, so a missing list
# is the text 'null' and a present one is '["a", "b"]' (with a space).
_LEGACY_LIST = "coalesce(replace(CAST(to_json({c}) AS VARCHAR), '\",\"', '\", \"'), 'null')"


def _legacy_list(c: str):
    return F.coalesce(F.replace(F.to_json(c), F.lit('","'), F.lit('", "')), F.lit("null"))


@register(
    "display_list",
    with_ctes(*ENRICH_CTES)
    + "SELECT record_id, "
    + ", ".join(
        "CASE WHEN {v} IS NULL OR lower({s}) IN ('', 'null', 'none') THEN NULL "
        "ELSE {d} END AS {c}_display".format(
            v="(" + _LEGACY_LIST.format(c=c) + ")",
            s=d_strip("(" + _LEGACY_LIST.format(c=c) + ")"),
            d=d_display_list(d_strip("(" + _LEGACY_LIST.format(c=c) + ")")),
            c=c,
        )
        for c in LIST_COLUMNS
    )
    + " FROM catalog_enriched",
)
def q_display_list(spark, sf_dir):
    """P15 + P16 on legacy list text: 'null' -> NULL, list text -> 'a, b'."""
    e = enriched_df(spark, sf_dir)
    return e.select(
        "record_id",
        *[display_list(clean_sentinel(_legacy_list(c))).alias(f"{c}_display") for c in LIST_COLUMNS],
    )


@register(
    "clean_sentinels",
    with_ctes(*ENRICH_CTES)
    + "SELECT record_id, "
    + ", ".join(
        "CASE WHEN lower({s}) IN ('', 'null', 'none') THEN NULL ELSE {s} END AS {c}".format(
            s=d_strip(f"CAST({c} AS VARCHAR)"), c=c
        )
        for c in ("title", "year", "publisher", "summary", "isbn")
    )
    + " FROM catalog_enriched",
)
def q_clean_sentinels(spark, sf_dir):
    """P15 on the displayed text fields."""
    e = enriched_df(spark, sf_dir)
    return e.select("record_id", *[clean_sentinel(c).alias(c) for c in ("title", "year", "publisher", "summary", "isbn")])


@register(
    "cover_url",
    with_ctes(*ENRICH_CTES)
    + "SELECT record_id, CASE WHEN isbn IS NOT NULL AND isbn <> '' THEN "
    "'https://covers.openlibrary.org/b/isbn/' || isbn || '-L.jpg' END AS cover_url FROM catalog_enriched",
)
def q_cover_url(spark, sf_dir):
    """P17."""
    return enriched_df(spark, sf_dir).select("record_id", cover_url("isbn").alias("cover_url"))


@register(
    "fill_display",
    with_ctes(*ENRICH_CTES)
    + f"SELECT record_id, coalesce(nullif(title, ''), '{UNTITLED}') AS title_label, "
    f"coalesce(nullif(publisher, ''), '{NOT_AVAILABLE}') AS publisher_label, "
    f"coalesce(nullif(summary, ''), '{NOT_AVAILABLE}') AS summary_label FROM catalog_enriched",
)
def q_fill_display(spark, sf_dir):
    """P18."""
    e = enriched_df(spark, sf_dir)
    return e.select(
        "record_id",
        fill_display("title", UNTITLED).alias("title_label"),
        fill_display("publisher", NOT_AVAILABLE).alias("publisher_label"),
        fill_display("summary", NOT_AVAILABLE).alias("summary_label"),
    )


@register(
    "pages_integer",
    with_ctes(CATALOG_CTE)
    + "SELECT row_pos, pages, CASE WHEN regexp_matches(trim(pages), '^[+-]?\\d+$') "
    "THEN try_cast(trim(pages) AS BIGINT) END AS pages_int FROM catalog_raw",
)
def q_pages_integer(spark, sf_dir):
    """P19."""
    return catalog_raw(spark, sf_dir).select("row_pos", "pages", integer_affinity("pages").alias("pages_int"))


# ---------------------------------------------------------------------------
# Stage statistics
# ---------------------------------------------------------------------------


@register(
    "raw_profile",
    with_ctes(CATALOG_CTE)
    + "SELECT count(*) AS n_rows, count(DISTINCT title) AS n_distinct_title, "
    "count(*) FILTER (WHERE title IS NULL) AS n_missing_title, "
    "count(*) FILTER (WHERE isbn IS NULL) AS n_missing_isbn FROM catalog_raw",
)
def q_raw_profile(spark, sf_dir):
    """A1-A3 on the raw catalogue."""
    p = profile(catalog_raw(spark, sf_dir), distinct=["title"], missing=["title", "isbn"])
    return p


@register(
    "clean_profile",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE)
    + "SELECT count(*) AS n_rows, count(DISTINCT record_id) AS n_distinct_record_id, "
    "count(DISTINCT isbn) AS n_distinct_isbn, count(*) FILTER (WHERE isbn IS NULL) AS n_missing_isbn, "
    "count(*) FILTER (WHERE year IS NULL) AS n_missing_year, count(isbn) AS n_present_isbn FROM catalog_clean",
)
def q_clean_profile(spark, sf_dir):
    """A1-A3 on the clean table (ISBN-based vs non-ISBN books)."""
    return profile(
        clean_catalog_df(spark, sf_dir, (*KEY_COLUMNS, "year")),
        distinct=["record_id", "isbn"],
        missing=["isbn", "year"],
        present=["isbn"],
    )


@register(
    "rows_removed",
    with_ctes(CATALOG_CTE, NORMALIZED_CTE, CLEAN_CTE)
    + "SELECT (SELECT count(*) FROM catalog_raw) AS rows_before, (SELECT count(*) FROM catalog_clean) AS rows_after, "
    "(SELECT count(*) FROM catalog_raw) - (SELECT count(*) FROM catalog_clean) AS rows_removed",
)
def q_rows_removed(spark, sf_dir):
    """Rows removed by cleaning."""
    return removed(catalog_raw(spark, sf_dir), clean_catalog_df(spark, sf_dir, KEY_COLUMNS))


@register(
    "stage_summary",
    with_ctes(*ENRICH_CTES)
    + "SELECT 'raw' AS stage, 0 AS stage_order, count(*) AS n_rows FROM catalog_raw UNION ALL "
    "SELECT 'ingested', 1, count(*) FROM catalog_raw UNION ALL "
    "SELECT 'cleaned', 2, count(*) FROM catalog_clean UNION ALL "
    "SELECT 'enriched', 3, count(*) FROM catalog_enriched UNION ALL "
    "SELECT 'found', 4, count(*) FROM catalog_enriched WHERE status = 'FOUND'",
)
def q_stage_summary(spark, sf_dir):
    """Rows per stage, every stage counted on its own; the ingested rows
    are those read back from CSV files."""
    enriched = enriched_table(spark, sf_dir)
    return stage_summary(
        {
            "raw": catalog_raw(spark, sf_dir),
            "ingested": ingested_catalog(spark, sf_dir),
            "cleaned": clean_catalog_df(spark, sf_dir, KEY_COLUMNS),
            "enriched": enriched,
            "found": enriched.where("status = 'FOUND'"),
        }
    )


@register(
    "store_stats",
    with_ctes(*ENRICH_CTES)
    + "SELECT count(DISTINCT book_key) AS final_books_count, count(DISTINCT title) AS unique_titles, "
    "count(DISTINCT isbn) AS unique_isbn FROM catalog_enriched",
)
def q_store_stats(spark, sf_dir):
    """A9."""
    return store_stats(enriched_df(spark, sf_dir))


# Deliveries of order lines that are sketched one by one.
SKETCHED = 4


@register(
    "distinct_by_month",
    "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_parts, "
    "count(DISTINCT l_orderkey) AS n_orders, true AS within_bound FROM lineitem GROUP BY 1",
)
def q_distinct_by_month(spark, sf_dir):
    """A2, A9 from sketches of four deliveries, stored by day and put together
    by month, held against exact counts."""
    lines = read_table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    lines = lines.select("day", "l_partkey", "l_orderkey", "l_linenumber")
    table = SketchTable(spark, scratch_path(spark, "sketches"), ["l_partkey", "l_orderkey"], by=["month", "day"])
    lines = lines.withColumn("month", F.trunc("day", "month"))
    for i in range(SKETCHED):
        table.deliver(lines.where(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(SKETCHED)) == i), f"d{i}")
    exact = lines.groupBy("month").agg(F.count_distinct("l_partkey").alias("n_parts"), F.count_distinct("l_orderkey").alias("n_orders"))
    got = table.estimates(by=["month"]).withColumnRenamed("month", "_month")
    near = F.lit(True)
    for est, want in (("n_distinct_l_partkey", "n_parts"), ("n_distinct_l_orderkey", "n_orders")):
        near = near & (F.abs(F.col(est) - F.col(want)) <= error() * F.col(want))
    return exact.join(got, F.col("month").eqNullSafe(F.col("_month"))).select("month", "n_rows", "n_parts", "n_orders", near.alias("within_bound"))
