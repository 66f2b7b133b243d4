import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import hard_negatives as hn
from folio.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """All results by whole-number inner products over the distinct rows."""
    width = max([len(v) for _, v, _ in rows], default=0)
    distinct = {}
    for i, v, l in rows:
        q = np.zeros(width, object)
        q[:len(v)] = [int(np.floor(x * 256)) for x in v]
        distinct[(i, l, tuple(q))] = None
    rows = list(distinct)
    out = []
    for a in (r for r in rows if r[0] % 100 == 0):
        s = {r: sum(x * y for x, y in zip(r[2], a[2])) for r in rows}
        best = sorted(rows, key=lambda r: (-s[r], r[0]))
        for p in [r for r in best if r != a and r[1] == a[1]][:5]:
            near = [r for r in best if r[1] != a[1] and 30 * s[p] <= 100 * s[r] <= 90 * s[p]][:10]
            out += [(a[0], p[0], k, r[0], s[p], s[r]) for k, r in enumerate(near, 1)]
    return sorted(out)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 20), st.integers(1, 12), st.integers(0, 2**32 - 1))
def test_lookups_give_inner_products(width, planes, seed):
    rng = np.random.default_rng(seed)
    top = 1 << (planes - 1)
    rows, anchors = (rng.integers(-top, top, (n, width)) for n in (9, 5))
    a = hn.unpack(hn.pack(anchors, planes))
    assert (a[:, :width] == anchors).all() and not a[:, width:].any()
    assert (hn.scores(hn.pack(rows, planes), hn.subset_sums(a)) == rows @ anchors.T).all()


def vectors(n, seed=3, dims=11, labels=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 6, dims))
    rows = [(i, (base[i % len(base)] + 0.4 * rng.normal(size=dims)).tolist(), int(rng.integers(0, labels))) for i in range(n)]
    # Ties: the same vector under several ids, and one label with a third of all rows.
    return [(i, rows[7][1] if i % 29 == 0 else v, 0 if i % 3 == 0 else l) for i, v, l in rows]


@pytest.mark.parametrize("chunk", [4096, 2])
def test_equal_to_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(hn, "CHUNK", chunk)
    monkeypatch.setattr(hn, "LOOKUP_ANCHORS", 3)
    monkeypatch.setattr(hn, "LOOKUP_ROWS", 50)
    rows = vectors(600)
    got = sorted(tuple(r) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect())
    assert got == brute(rows) and got


def test_few_positives_and_negatives(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.5, 0.1], 2), (3, [-1.0, 0.0], 2), (100, [0.2, 0.9], 3)]
    got = sorted(tuple(r) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows) and len(got) == 1  # a label of one row has no positive


def test_nulls_repeats_widths_and_extra_columns(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [0.5, 0.25, 0.1], 1), (0, [0.5, 0.25, 0.1], 1), (0, [0.5, 0.3], 1), (200, [], 1), (1, [0.4, 0.3], 1), (5, [0.3, 0.1, 0.2], 2), (5, [0.3, 0.1, 0.2], 2), (6, [0.25, 0.2], 2)]
    bad = [(None, [0.5, 0.25, 0.1], 1), (300, None, 1), (301, [0.5, None, 0.1], 1), (302, [0.5, nan, 0.1], 2), (303, [0.5, inf, 0.1], 2), (400, [0.5, 0.2, 0.1], None)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in good + bad], SCHEMA + ", slot int, packed string, rank int")
    assert sorted(tuple(r) for r in hn.hard_negatives(df).collect()) == brute(good)
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hn.hard_negatives(spark.createDataFrame(bad, SCHEMA)).collect() == []


def test_components_too_large_for_exact_scores_saturate(spark):
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 0.0], 1), (2, [6e5, 1e30], 2), (3, [-1e300, 0.0], 2)]
    got = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.positive_score for r in got} <= {1 << 60}


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows])
    assert sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, "/root/testdata/sf0.001").collect()) == want
