"""Incremental enrichment (X6) and the end-to-end run."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from folio.functions import book_key
from folio.plans.cleaning_queries import clean_catalog_df
from folio.plans.job_queries import write_raw_csv
from folio.plans.jobs import run_catalog
from folio.sources.catalog_views import catalog_meta
from folio.sources.sinks import read_flat
from folio.streaming.incremental import enrich_stream


def test_stream_resume_adds_nothing_twice(spark, tmp_dir):
    clean = clean_catalog_df(spark, SF_SMALL).withColumn("book_key", book_key())
    src, out, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "out", "ckpt"))
    clean.where("class_no_book_no = 'en'").drop("book_key").write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema
    meta = catalog_meta(spark, SF_SMALL)
    enrich_stream(spark, f"{src}/*", schema, meta, out, ckpt)
    n1 = spark.read.parquet(out).count()
    # Re-run with nothing new: no rows added.
    enrich_stream(spark, f"{src}/*", schema, meta, out, ckpt)
    assert spark.read.parquet(out).count() == n1
    # A new file overlapping old keys adds only the new keys.
    clean.drop("book_key").write.parquet(f"{src}/b")
    enrich_stream(spark, f"{src}/*", schema, meta, out, ckpt)
    final = spark.read.parquet(out)
    assert final.count() == final.select("book_key").distinct().count() == clean.select("book_key").distinct().count()
    # A later file repeating a's keys at earlier positions changes nothing:
    # the earliest batch that held a key wins.
    en = clean.where("class_no_book_no = 'en'").drop("book_key")
    en.withColumn("row_pos", F.col("row_pos") - 1_000_000).write.parquet(f"{src}/c")
    before = sorted(final.select("book_key", "row_pos").collect())
    enrich_stream(spark, f"{src}/*", schema, meta, out, ckpt)
    assert sorted(spark.read.parquet(out).select("book_key", "row_pos").collect()) == before
    # Even with a fresh checkpoint (full replay), the output stays unique.
    enrich_stream(spark, f"{src}/*", schema, meta, out, os.path.join(tmp_dir, "ckpt2"))
    assert spark.read.parquet(out).count() == final.count()


def test_end_to_end_from_csv(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    write_raw_csv(spark, SF_SMALL, raw)
    paths = run_catalog(spark, raw, catalog_meta(spark, SF_SMALL), os.path.join(tmp_dir, "run"))
    store = spark.read.parquet(paths.store)
    clean = spark.read.parquet(paths.cleaned)
    assert clean.count() == clean.select("record_id").distinct().count()
    assert store.count() == store.select("book_key").distinct().count() > 0
    feats = spark.read.parquet(paths.features)
    assert feats.columns == ["record_id", "title", "class_no_book_no", "intent", "depth", "publisher", "pages"]
    assert feats.count() == spark.read.parquet(paths.enriched).count() == clean.count()


def test_cli_stages(spark, tmp_dir):
    from folio.cli import main

    raw, meta = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "meta")
    write_raw_csv(spark, SF_SMALL, raw)
    catalog_meta(spark, SF_SMALL).write.parquet(meta)
    d = {n: os.path.join(tmp_dir, n) for n in ("ing", "per_source", "clean", "enr", "feat", "books")}
    main(["ingest", "--input-dir", raw, "--output-dir", d["ing"], "--per-source-dir", d["per_source"]], spark)
    ing = spark.read.parquet(d["ing"])
    inputs = {f for f in os.listdir(raw) if f.endswith(".csv")}
    assert {n for n in os.listdir(d["per_source"]) if n.startswith("source_file=")} == {
        f"source_file={f}" for f in inputs}
    per_source = read_flat(spark, d["per_source"])
    assert per_source.count() == ing.count()
    assert "row_pos" not in per_source.columns
    main(["clean", "--input-dir", d["ing"], "--output-dir", d["clean"]], spark)
    main(["enrich", "--input-dir", d["clean"], "--metadata", meta, "--output-dir", d["enr"], "--use-author"], spark)
    main(["features", "--input-dir", d["enr"], "--output-dir", d["feat"]], spark)
    main(["store", "--input-dir", d["enr"], "--store", d["books"]], spark)
    main(["store", "--input-dir", d["enr"], "--store", d["books"]], spark)  # idempotent
    main(["stats", "--ingested", d["ing"], "--clean", d["clean"], "--enriched", d["enr"]], spark)
    books = spark.read.parquet(d["books"])
    assert books.count() == books.select("book_key").distinct().count() > 0
    assert spark.read.parquet(d["feat"]).count() == spark.read.parquet(d["clean"]).count()


def test_stream_with_processing_time_trigger(spark, tmp_dir):
    clean = clean_catalog_df(spark, SF_SMALL)
    src, out, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "out", "ckpt"))
    clean.write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema
    query = enrich_stream(spark, f"{src}/*", schema, catalog_meta(spark, SF_SMALL), out, ckpt,
                          files_per_batch=10, processing_time="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    final = spark.read.parquet(out)
    assert final.count() == final.select("book_key").distinct().count() == clean.withColumn(
        "book_key", book_key()).select("book_key").distinct().count()
