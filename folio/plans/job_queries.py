"""Registered queries that run whole jobs: CSV round trip, incremental
enrichment, the end-to-end catalogue run and the pluggable dense encoder.

They write intermediate data under the session's shared checkpoint folder
(``spark.checkpoint.dir``), each run in a fresh sub-folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.constants import ENRICHED_COLUMNS, HASH_BUCKETS, NA_TOKENS, NUMERIC_PATTERN, TOKEN_SPLIT_PATTERN, WHITESPACE_CLASS
from folio.functions import book_key
from folio.operators.enrichment import build_lookup
from folio.operators.quality import profile
from folio.operators.vectors import encode, term_buckets
from folio.plans.cleaning_queries import clean_catalog_df
from folio.plans.enrichment_queries import ENRICH_COLUMNS, enriched_df
from folio.plans.jobs import build_embeddings, run_catalog
from folio.plans.registry import (
    CATALOG_CTE,
    ENRICH_CTES,
    register,
    with_ctes,
)
from folio.plans.retrieval_queries import SEMANTIC_SQL, d_term_counts
from folio.plans.raw_csv import NO_PAGES_ROWS, ingested_catalog, write_raw_csv
from folio.session import scratch_path
from folio.sources.catalog_views import CATALOG_RAW_SQL, catalog_meta
from folio.sources.sinks import (
    export_flat,
    read_embeddings,
    read_flat,
    read_latest,
    save_enriched,
    write_embeddings,
    write_per_source,
)
from folio.sources.tables import read_table
from folio.streaming.incremental import enrich_stream
from folio.streaming.keyed import enrich_stream_keyed, read_output

def _d_na(c: str) -> str:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {c} IN ({tokens}) THEN NULL ELSE {c} END"


@register(
    "csv_round_trip",
    with_ctes(CATALOG_CTE)
    + "SELECT "
    + f"{_d_na('accession_no')} AS accession_no, {_d_na('title')} AS title, "
    + f"{_d_na('author_editor')} AS author_editor, "
    + f"regexp_replace({_d_na('isbn')}, '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '', 'g') AS isbn, "
    + f"CASE WHEN regexp_matches({_d_na('year')}, '{NUMERIC_PATTERN}') THEN try_cast(trim(year) AS DOUBLE) END AS year, "
    + f"CASE WHEN {NO_PAGES_ROWS} THEN NULL ELSE {_d_na('pages')} END AS pages, "
    + f"{_d_na('class_no_book_no')} AS class_no_book_no, {_d_na('summary')} AS summary, "
    + f"CASE WHEN {NO_PAGES_ROWS} THEN {_d_na('class_no_book_no')} END AS extra FROM catalog_raw",
)
def q_csv_round_trip(spark, sf_dir):
    """Write the catalogue as Latin-1 CSV files with
    three header layouts, then ingest the directory back."""
    return ingested_catalog(spark, sf_dir).select(
        "accession_no", "title", "author_editor", "isbn", "year", "pages", "class_no_book_no",
        F.col("Summary").alias("summary"), F.col("Extra").alias("extra"),
    )


@register(
    "ingested_profile",
    with_ctes(CATALOG_CTE)
    + "SELECT count(*) AS n_rows, count(DISTINCT title) AS n_distinct_title, count(DISTINCT isbn) AS n_distinct_isbn, "
    "count(*) FILTER (WHERE isbn IS NULL) AS n_missing_isbn, count(*) FILTER (WHERE year IS NULL) AS n_missing_year FROM ("
    + f"SELECT {_d_na('title')} AS title, regexp_replace({_d_na('isbn')}, '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '', 'g') AS isbn, "
    + f"CASE WHEN regexp_matches({_d_na('year')}, '{NUMERIC_PATTERN}') THEN try_cast(trim(year) AS DOUBLE) END AS year FROM catalog_raw) x",
)
def q_ingested_profile(spark, sf_dir):
    """A1-A3 on the ingested stage, read back from CSV files."""
    return profile(ingested_catalog(spark, sf_dir), distinct=["title", "isbn"], missing=["isbn", "year"])


STORED_ENRICHED = ", ".join(["row_pos", *ENRICHED_COLUMNS, "match_tier"])

# Deliveries of new records in the incremental query, one scheduled run each.
DELIVERIES = 4


def _deliveries(spark, sf_dir, base):
    """Clean records staged as four deliveries; yields after each landed, with
    the schema and the metadata lookup."""
    # Each delivery holds the new keys of its turn and once more those of the
    # turn before.  Staging needs no shuffle: each task writes its own rows, so
    # a key holding many rows is still written by all tasks.
    staged = f"{base}/staged"
    clean_catalog_df(spark, sf_dir, ENRICH_COLUMNS).withColumn(
        "_turn", F.pmod(F.xxhash64(book_key()), F.lit(DELIVERIES))
    ).write.partitionBy("_turn").parquet(staged)
    schema = spark.read.parquet(staged).drop("_turn").schema
    lookup = build_lookup(catalog_meta(spark, sf_dir)).materialize()
    for d in range(DELIVERIES):
        delivery = spark.read.parquet(staged).where(F.col("_turn").isin(d, d - 1)).drop("_turn")
        delivery.write.parquet(f"{base}/source/d{d}")
        yield schema, lookup


INCREMENTAL_SQL = with_ctes(*ENRICH_CTES) + (
    f"SELECT {STORED_ENRICHED} FROM (SELECT *, row_number() OVER (PARTITION BY book_key ORDER BY row_pos) AS rn "
    "FROM catalog_enriched) x WHERE rn = 1"
)


@register("incremental_enrichment", INCREMENTAL_SQL)
def q_incremental_enrichment(spark, sf_dir):
    """Clean records arrive in four deliveries that repeat the keys of the
    one before; after each a scheduled streaming run (``availableNow``)
    enriches the new files, skipping keys already in the output (resume-safe)."""
    base = scratch_path(spark, "incremental")
    for schema, lookup in _deliveries(spark, sf_dir, base):
        enrich_stream(spark, f"{base}/source/*", schema, lookup, f"{base}/out", f"{base}/checkpoint",
                      files_per_batch=None)
    return spark.read.parquet(f"{base}/out").select(*STORED_ENRICHED.split(", "))


@register("incremental_enrichment_keyed", INCREMENTAL_SQL)
def q_incremental_enrichment_keyed(spark, sf_dir):
    """X6 with the finished keys in streaming state: the same deliveries and
    rows, but no run reads the output."""
    base = scratch_path(spark, "incremental-keyed")
    for schema, lookup in _deliveries(spark, sf_dir, base):
        enrich_stream_keyed(spark, f"{base}/source/*", schema, lookup, f"{base}/out", f"{base}/checkpoint",
                            files_per_batch=None)
    return read_output(spark, f"{base}/out").select(*STORED_ENRICHED.split(", "))


STORED_ROWS = (
    "row_pos, record_id, book_key, status, accession_no, class_no_book_no, pages, title, "
    "CAST(to_json(authors) AS VARCHAR) AS authors, isbn, year, CAST(to_json(subjects) AS VARCHAR) AS subjects, "
    "summary, publisher, CASE WHEN regexp_matches(trim(pages), '^[+-]?\\d+$') THEN try_cast(trim(pages) AS BIGINT) END AS pages_int"
)


# The catalogue as its CSV files hold it: one layout has no pages.
CATALOG_CSV_CTE = (
    f"catalog_raw AS (SELECT * REPLACE (CASE WHEN {NO_PAGES_ROWS} THEN NULL ELSE pages END AS pages) FROM ({CATALOG_RAW_SQL}) r)"
)


@register(
    "catalog_end_to_end",
    with_ctes(CATALOG_CSV_CTE, *ENRICH_CTES[1:])
    + f"SELECT {STORED_ROWS}, title AS feature_title, pages AS feature_pages, publisher AS feature_publisher FROM ("
    "SELECT *, row_number() OVER (PARTITION BY book_key ORDER BY row_pos) AS rn FROM catalog_enriched) x WHERE rn = 1",
)
def q_catalog_end_to_end(spark, sf_dir):
    """CSV files -> ingest -> clean -> enrich -> features -> store, each
    stage written and read back; returns the stored books with their features.
    Records come in the order of their accession number."""
    out = scratch_path(spark, "catalog-run")
    write_raw_csv(spark, sf_dir, f"{out}/raw")
    paths = run_catalog(spark, f"{out}/raw", catalog_meta(spark, sf_dir), out, position="accession_no")
    feats = spark.read.parquet(paths.features).select(
        "record_id", *[F.col(c).alias(f"feature_{c}") for c in ("title", "pages", "publisher")])
    return spark.read.parquet(paths.store).drop("match_tier").join(feats, "record_id")


@register(
    "per_source_round_trip",
    "SELECT doc_id, text, lang, n_chars, source FROM documents",
)
def q_per_source_round_trip(spark, sf_dir):
    """Every document (whole text, with its quotes and line breaks) written
    as CSV, one directory per source, then read back with fixed types."""
    path = scratch_path(spark, "per-source")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars", "source")
    write_per_source(docs, path, source_col="source")
    return read_flat(spark, path, schema=docs.schema).select("doc_id", "text", "lang", "n_chars", "source")


@register(
    "embeddings_round_trip",
    "SELECT CAST(vec_id AS VARCHAR) AS record_id, embedding FROM embeddings",
)
def q_embeddings_round_trip(spark, sf_dir):
    """Every embedding persisted with its id and loaded back unchanged."""
    path = scratch_path(spark, "embeddings")
    write_embeddings(read_table(spark, sf_dir, "embeddings"), path, id_col="vec_id", vec="embedding")
    return read_embeddings(spark, path)


def count_encoder(buckets: int = HASH_BUCKETS):
    """A text encoder for V2(b): hashed word counts.  Stands in for a
    pretrained model, which this environment does not ship; any
    ``batch -> (n, d)`` callable plugs in."""
    from folio.operators.vectors import bucket_counts

    return lambda: lambda ids: bucket_counts(ids, buckets)


@register(
    "dense_encoder",
    "WITH t AS (SELECT doc_id, CAST(('0x' || substr(md5(tok), 1, 4))::INT AS BIGINT) % "
    f"{HASH_BUCKETS} AS bucket, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), "
    f"'{TOKEN_SPLIT_PATTERN}')) AS tok FROM documents) x WHERE tok <> '' GROUP BY 1, 2), "
    "m AS (SELECT doc_id, map_from_entries(list((bucket, tf))) AS tfs, sqrt(sum(tf * tf)) AS norm FROM t GROUP BY 1) "
    f"SELECT doc_id, list_transform(range({HASH_BUCKETS}), lambda b: "
    "round(CAST(coalesce(m.tfs[b], 0) / coalesce(m.norm, 1) AS DOUBLE), 4)) AS vector FROM documents LEFT JOIN m USING (doc_id)",
)
def q_dense_encoder(spark, sf_dir):
    """V2(b): every document's full text through a pluggable encoder
    (mapInPandas, model built once per Python worker).  Tokens are hashed in
    the JVM; vectors are rounded to 4 decimals for comparison."""
    docs = term_buckets(read_table(spark, sf_dir, "documents", spread=True), "doc_id", "text", out="buckets")
    out = encode(docs, "doc_id", "buckets", count_encoder(), cache_key=f"counts-{HASH_BUCKETS}")
    return out.select("doc_id", F.transform("vector", lambda x: F.round(x.cast("double"), 4)).alias("vector"))


@register(
    "book_embeddings",
    with_ctes(*ENRICH_CTES)
    + f", sem AS (SELECT record_id, {SEMANTIC_SQL} AS semantic_text FROM catalog_enriched), "
    f"t AS ({d_term_counts('sem', 'record_id', 'semantic_text', 'record_id')}), "
    "m AS (SELECT record_id, map_from_entries(list((bucket, tf))) AS tfs, sqrt(sum(tf * tf)) AS norm FROM t GROUP BY 1) "
    f"SELECT record_id, list_transform(range({HASH_BUCKETS}), lambda b: "
    "round(CAST(coalesce(m.tfs[b], 0) / coalesce(m.norm, 1) AS DOUBLE), 4)) AS embedding FROM sem LEFT JOIN m USING (record_id)",
)
def q_book_embeddings(spark, sf_dir):
    """The embedding build: text -> vector -> saved with its id, read back
    (rounded to 4 decimals for comparison)."""
    path = scratch_path(spark, "book-embeddings")
    build_embeddings(enriched_df(spark, sf_dir), path)
    return read_embeddings(spark, path).select(
        "record_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 4)).alias("embedding"))


ENRICHED_ONLY = ", ".join(ENRICHED_COLUMNS)


@register(
    "enriched_json_round_trip",
    with_ctes(*ENRICH_CTES) + f"SELECT {ENRICHED_ONLY} FROM catalog_enriched",
)
def q_enriched_json_round_trip(spark, sf_dir):
    """S9 + S8: save the enriched records twice as new JSON-Lines versions
    (never overwriting what readers may be reading) and read the latest back
    with the fixed enriched schema."""
    base = scratch_path(spark, "enriched-versions")
    records = enriched_df(spark, sf_dir).select(*ENRICHED_COLUMNS)
    save_enriched(spark, records, base)
    save_enriched(spark, records, base)
    return read_latest(spark, base)


@register(
    "flat_export",
    with_ctes(*ENRICH_CTES)
    + "SELECT record_id, book_key, status, nullif(title, '') AS title, "
    "nullif(array_to_string(authors, ', '), '') AS authors, nullif(isbn, '') AS isbn, nullif(year, '') AS year, "
    "nullif(array_to_string(subjects, ', '), '') AS subjects, nullif(summary, '') AS summary, "
    "nullif(publisher, '') AS publisher FROM catalog_enriched",
)
def q_flat_export(spark, sf_dir):
    """Flat CSV snapshot of the enriched records (lists joined), read back.

    As in a pandas CSV snapshot, a missing value is an empty field, so an
    empty text and a missing one read back the same (NULL).
    """
    path = scratch_path(spark, "flat-export")
    export_flat(enriched_df(spark, sf_dir).select(*ENRICHED_COLUMNS), path)
    return read_flat(spark, path).select(
        "record_id", "book_key", "status", "title", "authors", "isbn", "year", "subjects", "summary", "publisher"
    )
