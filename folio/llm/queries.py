"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import decontam, hard_negatives, langid, licenses, quality_cnn, quality_rules, toxicity, vector_dup, warc, whitening
from folio.llm.common import documents, held_out
from folio.llm.near_dup import near_duplicates
from folio.llm.packing import TOKENIZER, pack
from folio.llm.suffix_dedup import PASSAGE, remove_repeats
from folio.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    rows = warc.round_trip(read_table(spark, sf_dir, "pages")).filter("kind = 'record'")
    page = F.regexp_extract("record_id", "<urn:page:(-?[0-9]+)>", 1)
    refers = F.regexp_extract("refers_to", "<urn:page:(-?[0-9]+)>", 1)
    return rows.select(F.when(page != "", page).cast("long").alias("page_id"),
                       "payload_bytes", "payload_digest", "record_type", F.when(refers != "", refers).cast("long").alias("refers_to"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document; learned from ``labels.toxic`` of
    the rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out())
    model = toxicity.fit(toxicity.graded(docs, labels), "grade")
    out = toxicity.predict(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "severity", F.col("at_least")[0].alias("p_toxic"), "grade",
                      (F.col("at_least")[0] >= 0.5).alias("toxic_pred"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.filter(~held_out()))
    return langid.predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 400-byte repeats take from every document, and a digest of the
    rest.  Beside it, ``n_passage``: bytes under repeats of the length of some
    50 words, which op4's 400 bytes leave alone."""
    out = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), passage=PASSAGE)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"), "n_passage")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices found in every document."""
    return licenses.scan(documents(spark, sf_dir)).select(
        "doc_id", "license", F.round("dice", 6).alias("dice"), F.size("licenses").alias("n_licenses"),
        F.array_join("licenses.name", ",").alias("all_licenses"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every document; trusted: label 1 for quality."""
    docs = documents(spark, sf_dir)
    trusted = read_table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.quality_rules(docs, trusted)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicates(documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, as ``labels.quality`` marks it."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out())
    model = quality_cnn.fit(docs, labels, "quality")
    return quality_cnn.predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, verbatim or re-parameterised."""
    return decontam.contaminated(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of 1024."""
    return pack(documents(spark, sf_dir), TOKENIZER)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive of ``embeddings``; the label
    of every seventh vec_id is moved on first."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every row of ``embeddings``."""
    rows = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    rows = rows.select("*", F.posexplode("whitened").alias("at", "white"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation as long)").alias("deviation"),
                       F.col("white").alias("whitened"), F.col("explained")[F.col("at")].alias("explained"), "identity_error")


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every row of ``embeddings``."""
    return vector_dup.near_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_warc, op2_toxicity, op3_language_id, op4_suffix_array_dedup, op5_license_scan, op6_quality_rules, op7_minhash_near_dedup,
    op8_quality_classifier, op9_benchmark_decontamination, op10_packing, op11_hard_negatives,
    op12_embedding_whitening, op13_embedding_near_dedup)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLES: dict[str, str] = {
    "op1_warc": """
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM (SELECT page_id, h, CASE WHEN strlen(h) >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS first
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
""",
    "op9_benchmark_decontamination": decontam.oracle_sql(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
