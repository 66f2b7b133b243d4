"""V7: approximate top-k against the exact one."""

import numpy as np
import pytest

from folio.operators import ann
from folio.operators.vectors import top_k_similar

ITEMS, QUERIES = "id long, vector array<double>", "qid long, vector array<double>"


def frames(spark, rows=900, dims=16, seed=2):
    """Clustered vectors; a third of the rows are near one point."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, dims))
    v = base[rng.integers(0, 60, rows)] + 0.3 * rng.normal(size=(rows, dims))
    v[::3] = base[0] + 0.05 * rng.normal(size=v[::3].shape)
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], ITEMS).repartition(5)
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v) if i % 20 == 1], QUERIES)
    return items, asked


def rows(df):
    return {(r.qid, r.id, r.score, r.rank) for r in df.collect()}


@pytest.mark.parametrize("block_rows", [100_000, 40])
def test_all_buckets_give_the_exact_answer(spark, tmp_dir, monkeypatch, block_rows):
    monkeypatch.setattr(ann, "BLOCK_ROWS", block_rows)
    items, asked = frames(spark)
    index = ann.build_index(items, f"{tmp_dir}/index", buckets=16)
    if block_rows == 40:
        assert index.blocks(spark).agg({"blocks": "max"}).first()[0] > 5  # the hot bucket is dealt out
    assert index.read(spark).count() == 2 * 900
    assert rows(ann.top_k_approx(asked, index, 6, 16)) == rows(top_k_similar(asked, items, 6))


def test_recall_is_reached_with_fewer_rows(spark, tmp_dir):
    items, asked = frames(spark)
    index = ann.build_index(items, f"{tmp_dir}/index", buckets=32)
    probes = ann.choose_probes(asked, items, index, 5, 0.95)
    assert probes < 16
    got = ann.top_k_approx(asked, index, 5, probes).cache()
    found = ann.recall(got, top_k_similar(asked, items, 5), "qid", "id").agg({"n_hits": "sum", "n_exact": "sum"}).first()
    assert found["sum(n_hits)"] >= 0.95 * found["sum(n_exact)"]
    assert max(r.n_scored for r in got.collect()) < 900 * 2


def test_an_index_serves_several_searches_and_reads_probed_buckets_only(spark, tmp_dir):
    items, asked = frames(spark)
    index = ann.build_index(items, f"{tmp_dir}/index", buckets=32)
    one = asked.limit(1)
    got = ann.top_k_approx(one, index, 3, 1)
    files = {r.f for r in index.read(spark).selectExpr("input_file_name() f").distinct().collect()}
    assert len(files) > 20
    assert [r.rank for r in got.orderBy("rank").collect()] == [1, 2, 3]
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [((tbl" in plan or "PartitionFilters: [(((tbl" in plan


def test_self_ties_zero_and_missing_vectors(spark, tmp_dir):
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [0.0, 1.0])]
    items = spark.createDataFrame(data, ITEMS)
    index = ann.build_index(items, f"{tmp_dir}/index", buckets=4)
    asked = spark.createDataFrame([(2, [1.0, 0.0]), (9, None)], QUERIES)
    assert rows(ann.top_k_approx(asked, index, 2, 4)) == {(2, 1, 1.0, 1), (2, 2, 1.0, 2)}
    assert rows(ann.top_k_approx(asked, index, 9, 4, exclude_self=True)) == {(2, 1, 1.0, 1), (2, 3, 1.0, 2), (2, 4, 0.0, 3), (2, 6, 0.0, 4)}
    empty = ann.build_index(items.limit(0), f"{tmp_dir}/empty", buckets=4)
    assert ann.top_k_approx(asked, empty, 2, 4).collect() == []
    assert ann.choose_probes(asked.limit(0), items, index, 3) == 1
