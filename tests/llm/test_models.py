"""Language, quality and toxicity: held-out accuracy and edge cases."""

import numpy as np
import pytest

from folio.llm import bytecnn, langid, quality_cnn, queries, toxicity
from tests.conftest import SF_ORACLE
from tests.llm.helpers import crowded, frame

LABELLED = "doc_id long, text string, lang string"
EDGES = [(1, None), (2, ""), (3, "123 !? 456"), (None, "the cat and the dog"), (5, "le chat et le chien"), (5, "le chat et le chien"), (6, "der hund " * 30_000)]


def test_windows_cover_every_byte_once_or_overlapping():
    data = np.arange(200, dtype=np.uint8)
    offs = np.array([0, 0, 10, 75, 200])
    for length, stride in ((16, 16), (16, 12)):
        x, owner, filled = bytecnn.windows(data, offs, length, stride)
        assert set(owner) == {0, 1, 2, 3}
        for row in range(4):
            seen = set(int(v) for w in x[owner == row] for v in w if v != bytecnn.PAD)
            assert seen == set(data[offs[row]:offs[row + 1]].tolist())
        assert (x[owner == 0] == bytecnn.PAD).all()
        if stride == length:
            assert np.bincount(owner, weights=filled)[1:].tolist() == [10, 65, 125]


def test_training_is_deterministic_and_fits():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 123, (200, 40)).astype(np.int16)
    y = rng.integers(0, 2, 200)
    x[y == 1, 10:13] = [120, 121, 122]
    a, b = (bytecnn.train(x, y, 2, 120) for _ in range(2))
    assert all((a[k] == b[k]).all() for k in a)
    assert (bytecnn.logits(a, x).argmax(1) == y).mean() > 0.95


def test_language_held_out_accuracy(spark):
    got = queries.op3_language_id(spark, SF_ORACLE).toPandas()
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang").toPandas()
    m = got.merge(docs, on="doc_id")
    assert len(m) == len(docs) and set(got.lang_pred) <= set(docs.lang)
    assert (m.lang_pred == m.lang)[m.held_out].mean() >= 0.97 and got.score.between(0, 1).all()


@pytest.fixture(scope="module")
def small_model(spark):
    rows = [(i, w, lang) for i in range(40) for w, lang in (("the cat and the dog of that house " * (1 + i % 3), "en"), ("le chat et le chien de cette maison " * (1 + i % 3), "fr"),
                                                           ("der hund und die katze von diesem haus " * (1 + i % 3), "de"))]
    rows += [(500, "nothing", None), (501, "nothing", " "), (502, None, "xx"), (503, "12 34", "yy"), (None, "ignored text", "zz")]
    return langid.fit(frame(spark, rows, LABELLED), steps=80)


def test_language_edges(spark, small_model):
    assert small_model.labels == ["de", "en", "fr"]
    for make in (frame, crowded):
        got = langid.predict(make(spark, EDGES).select("doc_id", "text"), small_model).collect()
        by = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in got}
        assert len(got) == len(EDGES)
        assert [by[(i, t)] for i, t in EDGES[:3]] == [("und", 0.0)] * 3
        assert by[EDGES[3]][0] == "en" and by[EDGES[4]][0] == "fr" and by[EDGES[6]][0] == "de"
    assert langid.predict(crowded(spark, EDGES), small_model).count() == len(EDGES)
    assert langid.predict(frame(spark, []), small_model).collect() == []


def test_language_without_labels(spark):
    model = langid.fit(frame(spark, [], LABELLED))
    assert [r.lang_pred for r in langid.predict(frame(spark, EDGES), model).collect()] == ["und"] * len(EDGES)


def test_language_capitals(spark, small_model):
    got = langid.predict(frame(spark, [(1, "THE CAT AND THE DOG OF THAT HOUSE"), (2, "LE CHAT ET LE CHIEN DE CETTE MAISON")]), small_model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["en", "fr"]


def test_quality_held_out(spark):
    got = queries.op8_quality_classifier(spark, SF_ORACLE).toPandas()
    marks = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas()
    m = got.merge(marks, on="doc_id")
    m = m[m.held_out]
    good, bad = m.score[m.quality == 1].to_numpy(), m.score[m.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (m.predicted == m.quality).mean() > 0.93
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert len(got) == spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()


def test_quality_edges(spark):
    labelled = frame(spark, [(i, ("fine words here " if i % 2 else "## !! $$ ") * (i + 1), i % 2) for i in range(40)] + [(99, "x", None)],
                     "doc_id long, text string, quality int")
    model = quality_cnn.fit(labelled, labelled, "quality", steps=60)
    got = quality_cnn.predict(crowded(spark, EDGES), model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert quality_cnn.predict(frame(spark, []), model).collect() == []
    one = quality_cnn.fit(labelled, labelled.filter("quality = 1"), "quality")
    assert [r.score for r in quality_cnn.predict(frame(spark, EDGES[:2]), one).collect()] == [1.0, 1.0]
    none = quality_cnn.fit(labelled, labelled.filter("quality = 7"), "quality")
    assert [r.score for r in quality_cnn.predict(frame(spark, EDGES[:2]), none).collect()] == [0.5, 0.5]


def test_toxicity_held_out(spark):
    got = queries.op2_toxicity(spark, SF_ORACLE).toPandas()
    marks = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas()
    m = got.merge(marks, on="doc_id")
    seen, held = m[~m.held_out], m[m.held_out]
    assert (seen.toxic_pred == (seen.toxic == 1)).mean() > 0.98
    assert held.severity[held.toxic == 1].median() > 5 * held.severity[held.toxic == 0].median()
    assert held.toxic_pred[held.toxic == 0].mean() < 0.05
    assert got.severity.between(0, 2).all() and len(got) == spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()


def test_ordinal_cuts_are_ordered_and_share_weights():
    rng = np.random.default_rng(1)
    grade = rng.integers(0, 4, 600)
    row, bucket = [], []
    for i, g in enumerate(grade):  # grade g: g of three telling buckets, and noise
        for b in [*rng.permutation(3)[:g], *(rng.integers(100, 3000, 20))]:
            row.append(i)
            bucket.append(int(b))
    pairs = np.unique(np.stack([row, bucket], 1), axis=0)
    model = toxicity.fit_ordinal(pairs[:, 0], pairs[:, 1], grade)
    score = np.bincount(pairs[:, 0], weights=model.weights[pairs[:, 1]], minlength=600)
    p = toxicity.sigmoid(score[:, None] - model.cuts)
    assert (np.diff(model.cuts) >= 0).all() and (np.diff(p, axis=1) <= 1e-12).all()
    assert np.abs(p.sum(1) - grade).mean() < 0.35
    noise = np.abs(model.weights[100:3000])
    assert (model.weights[:3] > 3).all() and (noise == 0).mean() > 0.7 and noise.mean() < 0.2


def test_toxicity_edges(spark):
    rows = [(i, "kind words all day" if i % 3 else "vile scum talk" + " scum" * (i % 2) + (" vile idiot" if i % 2 else ""), int(i % 3 == 0)) for i in range(60)] + [(99, "x", None)]
    docs = frame(spark, rows, "doc_id long, text string, toxic int")
    graded = toxicity.graded(docs, docs.unionAll(docs))
    assert graded.count() == 60
    assert {r.grade for r in graded.collect()} <= {0, 1, 2}
    model = toxicity.fit(graded, "grade")
    got = toxicity.predict(crowded(spark, EDGES), model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.severity <= len(model.cuts) for r in got)
    assert toxicity.predict(frame(spark, []), model).collect() == []
    assert [r.severity for r in toxicity.predict(frame(spark, EDGES), toxicity.fit(graded.filter("grade > 7"), "grade")).collect()] == [0.0] * len(EDGES)
