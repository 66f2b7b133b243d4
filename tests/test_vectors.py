"""Vectors: normalisation, encoders, exact top-k."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from folio.operators.vectors import (
    align_embeddings,
    encode,
    l2_normalize_vectors,
    semantic_text,
    term_vectors,
    top_k_similar,
    validate_embeddings,
)


def brute_force(q, e, k, qids, eids, min_score=None):
    out = set()
    for i, qv in enumerate(q):
        s = [float(np.round(np.dot(qv, ev) / (np.linalg.norm(qv) * np.linalg.norm(ev)), 6))
             if np.linalg.norm(ev) > 0 and np.linalg.norm(qv) > 0 else 0.0 for ev in e]
        order = sorted(range(len(e)), key=lambda j: (-s[j], eids[j]))
        order = [j for j in order if min_score is None or s[j] > min_score][:k]
        out |= {(qids[i], eids[j], r + 1) for r, j in enumerate(order)}
    return out


@pytest.fixture()
def vectors(spark):
    rng = np.random.default_rng(3)
    e = rng.standard_normal((300, 8)).round(2)
    e[5] = e[7]  # exact tie: broken by id
    e[9] = 0.0  # zero vector
    q = rng.standard_normal((7, 8)).round(2)
    items = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(e)], "id long, vector array<double>").repartition(5)
    queries = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(q)], "qid long, vector array<double>")
    return q, e, queries, items


@pytest.mark.parametrize("bound", [2048, 3])
def test_top_k_exact_both_paths(spark, vectors, bound):
    q, e, queries, items = vectors
    got = top_k_similar(queries, items, 5, max_broadcast_queries=bound, query_block_bytes=3 * 64, item_block_bytes=64 * 64)
    got = {(r["qid"], r["id"], r["rank"]) for r in got.collect()}
    assert got == brute_force(q, e, 5, list(range(len(q))), list(range(len(e))))


@pytest.mark.parametrize("bound", [2048, 3])
def test_top_k_hot_tie_group(spark, bound):
    """A third of the items share one vector that ranks first for a query: the
    k-th cut falls inside that tie group and ids decide, on both paths."""
    rng = np.random.default_rng(11)
    e = rng.standard_normal((240, 6)).round(2)
    hot = rng.standard_normal(6).round(2)
    hot_ids = rng.choice(len(e), size=len(e) // 3, replace=False)
    e[hot_ids] = hot
    q = np.vstack([hot, rng.standard_normal((4, 6)).round(2)])
    items = spark.createDataFrame(
        [(int(i), [float(x) for x in v]) for i, v in enumerate(e)], "id long, vector array<double>"
    ).repartition(6)
    queries = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(q)], "qid long, vector array<double>")
    got = top_k_similar(queries, items, 7, max_broadcast_queries=bound, query_block_bytes=2 * 48, item_block_bytes=40 * 48)
    got = {(r["qid"], r["id"], r["rank"]) for r in got.collect()}
    want = brute_force(q, e, 7, list(range(len(q))), list(range(len(e))))
    assert got == want
    assert {i for qid, i, _ in want if qid == 0} == set(int(x) for x in sorted(hot_ids)[:7])


def test_k_larger_than_items(spark, vectors):
    q, e, queries, items = vectors
    small = items.where("id < 3")
    assert top_k_similar(queries, small, 10).groupBy("qid").count().where("count <> 3").count() == 0


def test_l2_normalize_zero_vector(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<double>")
    assert [r[0] for r in l2_normalize_vectors(df).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_semantic_text_and_term_vectors(spark):
    df = spark.createDataFrame(
        [("1", "  Sum  ", ["a", "b"], "T", None, " "), ("2", None, None, None, None, None)],
        "id string, summary string, subjects array<string>, title string, publisher string, class_no_book_no string",
    )
    st = {r["id"]: r["semantic_text"] for r in semantic_text(df).collect()}
    assert st == {"1": "Sum a, b T", "2": ""}
    tv = {r["id"]: r["vector"] for r in term_vectors(semantic_text(df), "id", "semantic_text").collect()}
    assert len(tv["1"]) == 256 and sum(tv["1"]) == 4 and sum(tv["2"]) == 0


def test_pluggable_encoder(spark):
    def factory():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([(1, "abc"), (2, None)], "id int, text string")
    out = {r["id"]: r["vector"] for r in encode(df, "id", "text", factory).collect()}
    assert np.allclose(out[1], np.array([3, 1]) / np.sqrt(10)) and np.allclose(out[2], [0, 1])


def test_encoder_gets_slices_of_an_arrow_batch(spark):
    """a worker holds the vectors of a slice, not of a whole Arrow batch."""
    df = spark.range(3000).coalesce(1).withColumn("text", F.col("id").cast("string"))
    out = encode(df, "id", "text", lambda: lambda texts: np.array([[len(texts), 1.0, float(t)] for t in texts])).collect()
    got = {r["id"]: np.array(r["vector"]) for r in out}
    assert len(out) == len(got) == 3000
    assert max(round(v[0] / v[1]) for v in got.values()) <= 1024
    assert all(round(v[2] / v[1]) == i for i, v in got.items())


def test_bucket_counts_of_many_rows():
    import tracemalloc

    from folio.operators.vectors import bucket_counts

    ids = [None if i % 7 == 0 else [i % 16] * (i % 3) + [15] for i in range(5000)]
    want = np.zeros((5000, 16))
    for i, v in enumerate(ids):
        for b in v or []:
            want[i, b] += 1
    assert np.array_equal(bucket_counts(ids, 16), want)
    assert np.array_equal(bucket_counts(pd.Series(ids), 16), want) and bucket_counts([], 16).shape == (0, 16)
    tracemalloc.start()
    bucket_counts(ids, 1024)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * 5000 * 1024 * 8  # the result and a slice


def test_validate_embeddings(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    emb = spark.createDataFrame([(2, [1.0]), (3, [1.0, 2.0]), (4, [0.5])], "id int, embedding array<double>")
    r = validate_embeddings(ids, emb, "id").first()
    assert (r["n_ids"], r["n_vectors"], r["n_matched"], r["n_ids_without_vector"], r["n_vectors_without_id"],
            r["n_dimensions"], r["valid"]) == (3, 3, 2, 1, 1, 2, False)


def test_align_embeddings_hot_key_and_nulls(spark):
    """One key holds a third of the embedding rows; NULL keys on both sides.
    Same rows as a full outer join, planned without one."""
    id_rows = [(i,) for i in range(0, 60, 2)] + [(4,), (None,)]
    emb_rows = [(7, [1.0, 2.0])] * 40 + [(i, [float(i)]) for i in range(0, 80, 3)] + [(None, [0.0])]
    ids = spark.createDataFrame(id_rows, "id int").repartition(3)
    emb = spark.createDataFrame(emb_rows, "id int, embedding array<double>").repartition(4)
    got = align_embeddings(ids, emb, "id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan

    distinct_ids = {r[0] for r in id_rows}
    want = Counter()
    matched = set()
    for k, v in emb_rows:  # every embedding row; NULL never matches
        has_id = k is not None and k in distinct_ids
        matched |= {k} if has_id else set()
        want[(k, has_id, True, len(v))] += 1
    for k in distinct_ids - matched:
        want[(k, True, False, None)] += 1
    assert Counter((r["id"], r["has_id"], r["has_vector"], r["dimension"]) for r in got.collect()) == want


def test_chunked_scoring_equals_unchunked(spark, vectors, monkeypatch):
    import folio.operators.vectors as V

    q, e, queries, items = vectors
    monkeypatch.setattr(V, "SCORE_CELLS", 20)  # forces many tiny chunks
    got = {(r["qid"], r["id"], r["rank"]) for r in top_k_similar(queries, items, 5).collect()}
    assert got == brute_force(q, e, 5, list(range(len(q))), list(range(len(e))))


def test_encoder_cached_per_worker_gives_same_vectors(spark):
    def factory():
        return lambda texts: np.array([[len(t), 2.0] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(50)], "id int, text string").repartition(4)
    plain = {r["id"]: r["vector"] for r in encode(df, "id", "text", factory).collect()}
    cached = {r["id"]: r["vector"] for r in encode(df, "id", "text", factory, cache_key="t-len").collect()}
    again = {r["id"]: r["vector"] for r in encode(df, "id", "text", factory, cache_key="t-len").collect()}
    assert plain == cached == again


def test_ties_stay_within_k_rows_per_query_and_task(spark, monkeypatch):
    """A third of the items are identical: every task still returns at most k
    rows per query, and the smallest ids win."""
    from pyspark.sql import functions as F

    from folio.operators import vectors as V

    n, k = 3000, 5
    items = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(1.0)))
                                  .otherwise(F.array(F.col("id") * 1.0, F.lit(1.0))).alias("vector")).repartition(6)
    queries = spark.createDataFrame([(q, [1.0, 1.0]) for q in range(20)] + [(99, [0.0, 0.0])], "qid int, vector array<double>")
    seen = {}
    plain = V._BestK.rows

    def rows(self):
        out = plain(self)
        assert len(out[0]) <= self.k * len(self.qids)
        return out

    monkeypatch.setattr(V._BestK, "rows", rows)
    for r in top_k_similar(queries, items, k).collect():
        seen.setdefault(r["qid"], []).append((r["rank"], r["id"], r["score"]))
    want = [(i + 1, v, 1.0) for i, v in enumerate([0, 1, 3, 6, 9])]
    assert all(sorted(seen[q]) == want for q in range(20))
    assert [v for _, v, _ in sorted(seen[99])] == [0, 1, 2, 3, 4]  # a zero query scores 0 everywhere


def test_missing_text_has_no_terms(spark):
    from folio.operators.vectors import bucket_of, term_buckets, term_vectors

    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b a")], "id int, text string")
    got = {r["id"]: sum(r["vector"]) for r in term_vectors(df, "id", "text", 16).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 3.0}
    assert {r["id"]: len(r["vector"]) for r in term_buckets(df, "id", "text", 16).collect()} == {1: 0, 2: 0, 3: 3}
    assert top_k_similar(term_vectors(df, "id", "text", 16).withColumnRenamed("id", "qid"), term_buckets(df, "id", "text", 16),
                         min_score=0.0, item_buckets=16).select("qid", "id").collect() == [(3, 3)]
    with pytest.raises(ValueError):
        bucket_of(df["text"], 1 << 17)


def test_validation_counts_every_row(spark):
    from folio.operators.vectors import require_aligned, validate_embeddings

    def ids(*v):
        return spark.createDataFrame([(x,) for x in v], "id int")

    def emb(*v):
        return spark.createDataFrame([(x, [1.0, 2.0]) for x in v], "id int, embedding array<double>")

    for a, b, want in (((1, 2), (1, 2), (2, 2, True)), ((1, 2), (1, 1, 2), (2, 3, False)), ((1, 1, 2), (1, 2), (3, 2, False)), ((1,), (2,), (1, 1, False))):
        r = validate_embeddings(ids(*a), emb(*b), "id").first()
        assert (r["n_ids"], r["n_vectors"], r["valid"]) == want
        if want[2]:
            assert require_aligned(ids(*a), emb(*b), "id").count() == len(b)
        else:
            with pytest.raises(ValueError):
                require_aligned(ids(*a), emb(*b), "id")


def test_top_k_defaults_to_five_and_at_least_one(spark):
    items = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)], "id int, vector array<double>")
    queries = spark.createDataFrame([(1, [1.0, 1.0])], "qid int, vector array<double>")
    assert top_k_similar(queries, items).count() == 5
    assert top_k_similar(queries, items, 0).count() == 1
