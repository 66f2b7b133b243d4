"""A label column with more distinct values than get the full sample."""

from pyspark.sql import functions as F

from folio.llm import langid
from tests.llm.helpers import frame

LABELLED = "doc_id long, text string, lang string"


def test_more_than_500_labels_are_learned(spark):
    rows = [(i, "the cat and the dog of that house " * 3, "en") for i in range(300)]
    rows += [(1000 + i, f"word{i} text", f"junk{i}") for i in range(700)]
    docs = frame(spark, rows, LABELLED)
    model = langid.fit(docs, per_label=80, steps=20)
    assert model.labels == sorted({r[2] for r in rows})
    assert langid.predict(docs, model).count() == len(rows)


def test_the_sample_holds_the_smallest_hashes(spark):
    rows = [(i, "t", "a" if i % 3 else "b") for i in range(3000)]
    docs = frame(spark, rows, LABELLED)
    hashed = docs.select("doc_id", "lang", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect()
    got = {r.doc_id for r in langid.sample_labelled(docs, "lang", 50).collect()}
    want = {r.doc_id for v in "ab" for r in sorted((r for r in hashed if r.lang == v), key=lambda r: r.h)[:50]}
    assert got == want
