"""A training corpus from ``documents``, in five stages.

Each stage works on all rows its predecessor kept; ``run`` writes every
stage as Parquet in the shared checkpoint folder and reads it back for the
next one.  All stages but the last return the columns of ``documents``.

1. language ID: rows without a letter, or whose best language is less likely
   than ``LEAST_LANGUAGE``, go; a missing lang becomes the predicted one.
2. MinHash near-dedup: one document of each near-duplicate group stays.
   Unlike op7 (three words, 0.85) the stage links texts whose sets of
   five-word shingles have a Jaccard similarity of 0.8 or more.
3. suffix-array dedup: repeated strings of ``PASSAGE`` bytes, some 50 words,
   are cut out of the texts (a character that loses a byte goes whole);
   n_chars follows.  No row goes; a text may become empty.
4. benchmark decontamination: documents that hold a benchmark item go.
5. packing: token pieces, packed into sequences of 1024.

Null and repeated rows: see the operators; rows without doc_id pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import decontam, langid, near_dup, packing, suffix_dedup
from folio.llm.common import Stages, documents, held_out
from folio.sources.tables import read_table

LEAST_LANGUAGE = 0.3
#: Near-dedup: words of a shingle, least similarity in percent, and the
#: collision threshold: a pair at 0.8 agrees in 37 of the 64 coordinates with
#: probability 1 - 1.4e-5 (42, which suits 0.85, would miss one in 450).
NEAR_SHINGLE, NEAR_PERCENT, NEAR_MATCHES = 5, 80, 37
#: Bytes of a passage that repeats (op4 has 400): 51 words are 280 bytes or more
#: in 99 of 100 documents that share as many with another one; 400 bytes would
#: leave a quarter of them.
PASSAGE = suffix_dedup.PASSAGE
TOKENIZER = packing.TOKENIZER

#: The rows cannot be stated in SQL (trained network, tokenizer).
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.filter(~held_out()))
    out = langid.predict(docs, model).filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE))
    lang = F.when(F.length(F.trim("lang")) > 0, F.col("lang")).otherwise(F.col("lang_pred"))
    return out.withColumn("lang", lang).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT, matches=NEAR_MATCHES)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(docs, PASSAGE)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    out = out.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", near_dup_stage),
    ("suffix_array_dedup", suffix_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    st = Stages(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        docs = st.put(stage(spark, docs, sf_dir), name)
        if before:
            st.drop(before)
        before = name
    return docs
