"""End-to-end catalogue job (X1) built from the stage operators.

One Spark application chains the stages; every stage is written as a table
(Parquet) and the next stage reads that table back.  The writes are the
stage boundaries: they cut the lineage (a lost executor recomputes from the
last written stage, not from the raw input) and give each stage an
inspectable output, like the reference's files between scripts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.constants import DEFAULT_TOP_K, EMBED_COLUMNS
from folio.operators.cleaning import clean
from folio.operators.enrichment import enrich
from folio.operators.search import fetch_with_scores, page_results
from folio.operators.store import append_to_store, to_store_rows
from folio.operators.vectors import bucket_counts, encode, semantic_text, term_buckets, term_vectors, top_k_similar
from folio.sources.catalog_csv import ORDER_COLUMNS, ingest, ingest_frame
from folio.sources.sinks import write_embeddings, write_features, write_table


@dataclass
class CatalogRun:
    ingested: str
    cleaned: str
    enriched: str
    features: str
    store: str


def run_catalog(
    spark: SparkSession,
    raw: DataFrame | str,
    meta: DataFrame,
    out_dir: str,
    order: tuple[str, ...] | None = None,
    multiline: bool = True,
    position: str | None = None,
) -> CatalogRun:
    """Ingest -> clean -> enrich -> features -> store; stops on the first
    failing stage (an exception propagates and later stages never start).

    ``raw`` is a CSV directory (read with per-header groups) or an already
    loaded raw DataFrame.  ``order`` is the "first row" order for dedupe and
    the store; it defaults to file order for CSV input and ``row_pos``
    otherwise.  ``position`` names a column of the records that numbers them
    (unique, e.g. an accession number); their order is then that number's.
    """
    base = out_dir.rstrip("/")
    paths = CatalogRun(
        ingested=f"{base}/ingested",
        cleaned=f"{base}/clean",
        enriched=f"{base}/enriched",
        features=f"{base}/features",
        store=f"{base}/books",
    )
    if isinstance(raw, str):
        ingested = ingest(spark, raw, multiline)
        order = order or ORDER_COLUMNS
    else:
        ingested = ingest_frame(raw)
        order = order or ("row_pos",)

    if position is not None:
        ingested = ingested.withColumn("row_pos", F.col(position).cast("bigint"))
        order = ("row_pos",)

    write_table(ingested, paths.ingested)
    cleaned = clean(spark.read.parquet(paths.ingested), order)
    write_table(cleaned, paths.cleaned)
    enriched = enrich(spark.read.parquet(paths.cleaned), meta, carry=tuple(order))
    write_table(enriched, paths.enriched)
    stage = spark.read.parquet(paths.enriched)
    write_features(stage, paths.features)
    append_to_store(spark, to_store_rows(stage, keep=list(order)), paths.store, order=order)
    return paths


def build_embeddings(enriched: DataFrame, out_dir: str, encoder_factory=None, cache_key: str | None = None) -> None:
    """The embedding table of enriched records: semantic text, encoded, saved
    with its record ids (L2-normalised).

    Without ``encoder_factory`` the vectors are hashed word counts, bucketed
    in the JVM; an encoder gets the texts themselves.
    """
    text = semantic_text(enriched.select("record_id", *[c for c in EMBED_COLUMNS if c in enriched.columns]))
    if encoder_factory is None:
        rows = term_buckets(text, "record_id", "semantic_text", out="buckets")
        out = encode(rows, "record_id", "buckets", lambda: bucket_counts, out="embedding", cache_key=cache_key)
    else:
        out = encode(text, "record_id", "semantic_text", encoder_factory, out="embedding", cache_key=cache_key)
    write_embeddings(out, out_dir)


def recommend(books: DataFrame, embeddings: DataFrame, queries: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """V5 on stored vectors: (qid, text) queries -> the k nearest stored
    records, best first, with result pages."""
    vectors = term_vectors(queries, "qid", "text")
    found = top_k_similar(vectors, embeddings, k, query_id="qid", item_id="record_id", item_vec="embedding", min_score=0.0)
    return page_results(fetch_with_scores(books, found)).orderBy("qid", "rank")
