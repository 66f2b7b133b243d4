"""X6 with keyed state: same rows, no reads of the output, restart, replay."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from folio.functions import book_key
from folio.plans.cleaning_queries import clean_catalog_df
from folio.sources.catalog_views import catalog_meta
from folio.streaming import keyed
from folio.streaming.incremental import enrich_stream


@pytest.fixture(scope="module")
def clean(spark):
    return clean_catalog_df(spark, SF_SMALL).cache()


def paths(tmp_dir):
    return tuple(os.path.join(tmp_dir, n) for n in ("src", "out", "ckpt"))


def stored(spark, out):
    df = keyed.read_output(spark, out)
    return sorted(map(tuple, df.select("book_key", "row_pos", "status").collect()))


def test_same_rows_as_the_anti_join_and_no_reads_of_the_output(spark, clean, tmp_dir, monkeypatch):
    src, out, ckpt = paths(tmp_dir)
    meta = catalog_meta(spark, SF_SMALL)
    reads = []
    real = keyed.read_store
    monkeypatch.setattr(keyed, "read_store", lambda s, p: reads.append(p) or real(s, p))
    en = clean.where("class_no_book_no = 'en'")
    # b repeats a; c repeats it at earlier positions; a third of b is one key.
    hot = en.limit(1).crossJoin(spark.range(120).select(F.col("id").alias("_n"))).withColumn("row_pos", F.col("row_pos") + F.col("_n")).drop("_n")
    parts = [en, clean.unionByName(hot), en.withColumn("row_pos", F.col("row_pos") - 1_000_000)]
    for name, part in zip("abc", parts):
        part.write.parquet(f"{src}/{name}")
        keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, meta, out, ckpt, files_per_batch=None)
        enrich_stream(spark, f"{src}/*", clean.schema, meta, f"{tmp_dir}/out2", f"{tmp_dir}/ckpt2", files_per_batch=None)
    assert reads == [out]  # by the first start only, for the seeds; no batch reads it
    assert stored(spark, out) == sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out2").select("book_key", "row_pos", "status").collect()))
    keys = clean.select(book_key()).distinct().count()
    assert len(stored(spark, out)) == keys
    monkeypatch.undo()
    # Nothing new, and a lost checkpoint over the same files: nothing twice.
    assert keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, meta, out, ckpt) == 0
    keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, meta, out, f"{tmp_dir}/ckpt3", files_per_batch=None)
    assert len(stored(spark, out)) == keys


def test_a_batch_that_fails_after_its_write_is_replaced(spark, clean, tmp_dir, monkeypatch):
    src, out, ckpt = paths(tmp_dir)
    meta = catalog_meta(spark, SF_SMALL)
    clean.repartition(2).write.parquet(f"{src}/a")
    real = keyed.enrich

    class Boom:
        """Writes like the frame it holds, then fails as a lost driver would."""

        def __init__(self, df):
            self.df = df

        @property
        def write(self):
            outer = self

            class Writer:
                def mode(self, m):
                    return self

                def parquet(self, path):
                    outer.df.write.mode("overwrite").parquet(path)
                    raise RuntimeError("driver lost")

            return Writer()

    monkeypatch.setattr(keyed, "enrich", lambda *a, **k: Boom(real(*a, **k)))
    with pytest.raises(Exception):
        keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, meta, out, ckpt)
    assert len(stored(spark, out)) > 0
    monkeypatch.undo()
    keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, meta, out, ckpt)
    got = stored(spark, out)
    assert len(got) == len({r[0] for r in got}) == clean.select(book_key()).distinct().count()


def test_rows_without_a_key_all_pass(spark, clean, tmp_dir):
    src, out, ckpt = paths(tmp_dir)
    lost = clean.limit(3).withColumn("title", F.lit(None).cast("string")).withColumn("isbn", F.lit(None).cast("string"))
    for name in "ab":
        clean.limit(4).unionByName(lost).write.parquet(f"{src}/{name}")
        keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, catalog_meta(spark, SF_SMALL), out, ckpt)
    got = keyed.read_output(spark, out).select("book_key").collect()
    none = lost.select(book_key().alias("k")).where("k is null").count()
    assert sum(r.book_key is None for r in got) == 2 * none
    some = [r.book_key for r in got if r.book_key is not None]
    assert len(some) == len(set(some))


def test_provider_setting_is_put_back(spark, clean, tmp_dir):
    src, out, ckpt = paths(tmp_dir)
    before = spark.conf.get(keyed.PROVIDER, None)
    clean.limit(2).write.parquet(f"{src}/a")
    keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, catalog_meta(spark, SF_SMALL), out, ckpt)
    assert spark.conf.get(keyed.PROVIDER, None) == before


def test_state_is_one_entry_per_key_of_a_built_in_operator(spark, clean, tmp_dir):
    """no Python per key (3 copies of each key, at one position; the least JSON is first)."""
    src, out, ckpt = paths(tmp_dir)
    copies = clean.crossJoin(spark.range(3).select(F.col("id").cast("string").alias("accession_no"))).drop(clean["accession_no"]).select(*clean.columns)
    for name in "ab":  # the second delivery repeats the first
        copies.repartition(3).write.parquet(f"{src}/{name}")
        keyed.enrich_stream_keyed(spark, f"{src}/*", clean.schema, catalog_meta(spark, SF_SMALL), out, ckpt, files_per_batch=None)
    stream = next(f"{ckpt}/{n}" for n in os.listdir(ckpt) if os.path.isdir(f"{ckpt}/{n}/offsets"))
    assert [r.operatorName for r in spark.read.format("state-metadata").load(stream).collect()] == ["dedupe"]
    keys = clean.select(book_key()).distinct().count()
    assert spark.read.format("statestore").load(stream).count() == keys
    got = keyed.read_output(spark, out)
    assert got.count() == keys and {r[0] for r in got.select("accession_no").distinct().collect()} == {"0"}
    assert not os.path.isdir(f"{ckpt}/batches") or not [n for n in os.listdir(f"{ckpt}/batches") if not n.startswith(".")]
