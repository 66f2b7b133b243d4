from fractions import Fraction

import numpy as np
import pytest

from folio.llm import whitening as wh
from folio.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def whole(v, width):
    return tuple(int(np.floor(64 * c)) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))])


def brute(rows, k=16):
    """n, exact deviations, exact covariance (fractions rounded once), eigen."""
    width = max((len(v) for _, v in rows), default=0)
    xs = [whole(v, width) for _, v in rows]
    fit = sorted(set(xs))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = [[n * a - b for a, b in zip(x, s)] for x in fit]
    cov = np.array([[float(Fraction(sum(z[i] * z[j] for z in centred), n**3)) for j in range(width)] for i in range(width)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    z = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in xs])
    return n, [sum((n * a - b) ** 2 for a, b in zip(x, s)) for x in xs], cov, e, z @ v / np.sqrt(e)


def compare(got, rows, k=16):
    n, deviation, cov, e, white = brute(rows, k)
    by = {r.vec_id: r for r in got}
    mine = np.array([by[i].whitened for i, _ in rows])
    mine *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-8
    assert [int(by[i].deviation) for i, _ in rows] == deviation
    assert {r.n for r in got} == {n}
    assert np.allclose(got[0].explained, e / np.trace(cov), rtol=1e-9, atol=0)
    assert got[0].identity_error < 1e-9


def vectors(n, dims, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) @ np.diag(scale * np.linspace(0.5, 3, dims)) + 5
    return [(i, x[i if i % 3 else 0].tolist()) for i in range(n)]  # a third of the rows are one vector


@pytest.mark.parametrize("k", [3, 16])
def test_equal_to_exact_covariance(spark, k):
    rows = vectors(300, 20)
    compare(wh.whiten(spark.createDataFrame(rows, SCHEMA).repartition(7), k).collect(), rows, k)


def test_numbers_beyond_64_bits_stay_exact(spark):
    rows = vectors(90, 5, scale=1e9)
    compare(wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_pair_squares_recover_cross_covariances():
    rng = np.random.default_rng(2)
    x = rng.integers(-1000, 1000, (50, 6)) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centre = [(2 * int(s) + n) // (2 * n) for s in sums]
    model = wh.Whitening(n, [int(s) for s in sums], list(wh.pair_squares(x, np.array(centre))), 6)
    assert np.allclose(model.cov, np.cov(x.T, bias=True), rtol=1e-12)
    big = x * (1 << 33)  # squares leave 64 bits
    assert (wh.pair_squares(big, np.zeros(6, np.int64))[:6] == (big.astype(object) ** 2).sum(axis=0)).all()


def test_limbs_round_trip():
    values = [0, 1, -1, 2**130 + 5, -(2**130) - 7, 2**40, -(2**40)]
    assert [sum(p[i] << (40 * at) for at, p in enumerate(wh.limbs(values))) for i in range(len(values))] == values


def test_nulls_repeats_widths_and_extra_columns(spark):
    nan = float("nan")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [0.1]), (None, [2.0, -1.0]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [float("-inf"), 0.0]), (8, [])]
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], SCHEMA + ", n int, x string, whitened double")
    got = wh.whiten(df).collect()
    assert sorted((r.vec_id or 0) for r in got) == [0, 1, 1, 2, 8]
    assert {r.n for r in got} == {4} and got[0].identity_error < 1e-9
    assert {len(r.whitened) for r in got} == {2}


def test_no_variance_and_empty_table(spark):
    one = wh.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], SCHEMA)).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, [None, None], [None, None], 0.0)] * 2
    line = wh.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], SCHEMA)).collect()
    assert line[0].explained[0] == pytest.approx(1) and line[0].whitened[1] is None and abs(abs(line[0].whitened[0]) - 1) < 1e-12
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.whitened for r in wh.whiten(spark.createDataFrame([(1, [])], SCHEMA)).collect()] == [[]]


def test_query_rows(spark):
    got = QUERIES["op12_embedding_whitening"](spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert len(got) == 16 * len(rows) and {r.component for r in got} == set(range(1, 17))
    n, deviation, cov, e, _ = brute(rows)
    assert {r.vec_id: r.deviation for r in got} == dict(zip([i for i, _ in rows], deviation))
    assert {r.identity_error < 1e-4 for r in got} == {True}
