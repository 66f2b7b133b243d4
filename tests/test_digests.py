"""The report by digests equals the joined one; equal ranges are not joined."""

import random

import pytest

from folio.operators import digests as dg
from folio.operators.vectors import validate_embeddings


def tables(spark, ids, vectors):
    return (spark.createDataFrame([(i,) for i in ids], "id long").repartition(3),
            spark.createDataFrame([(i, [0.0] * d) for i, d in vectors], "id long, embedding array<double>").repartition(4))


def report(df):
    return {k: v for k, v in df.first().asDict().items() if k != "n_ranges_joined"}


def cases():
    rnd = random.Random(6)
    ids = rnd.sample(range(10_000), 700)
    whole = [(i, 4) for i in reversed(ids)]
    yield "equal", ids, whole
    yield "one id is missing", ids[1:], whole
    yield "one vector is missing", ids, whole[:-1]
    yield "an id twice", ids + ids[:3], whole
    yield "a vector twice", ids, whole + whole[:2]
    yield "both twice", ids + ids[:2], whole + [(i, 4) for i in ids[:2]]
    yield "as many, another key", ids[1:] + [20_000], whole
    yield "two dimensions", ids, whole[:-1] + [(whole[-1][0], 5)]
    yield "no key", ids + [None, None], whole + [(None, 4)]
    yield "no ids", [], whole
    yield "no vectors", ids, []
    yield "nothing", [], []
    yield "a hot key", ids + [77] * 400, whole + [(77, 4)] * 400


@pytest.mark.parametrize("name,ids,vectors", list(cases()), ids=[c[0] for c in cases()])
def test_same_report_as_the_join(spark, name, ids, vectors):
    left, right = tables(spark, ids, vectors)
    got = dg.validate_by_digests(left, right, "id", ranges=32)
    assert report(got) == report(validate_embeddings(left, right, "id"))


def test_only_differing_ranges_are_joined(spark):
    ids = list(range(2_000))
    left, right = tables(spark, ids[1:], [(i, 4) for i in ids])
    assert dg.validate_by_digests(left, right, "id", ranges=64).first().n_ranges_joined == 1
    digests = [dg.key_digests(t, "id", ranges=64) for t in (left, right)]
    rows = dg.in_ranges(right, "id", dg.differing(*digests), 64)
    assert 0 < rows.count() < 2_000 / 64 * 2
    same = dg.key_digests(right, "id", ranges=64)
    assert dg.differing(same, dg.key_digests(right.orderBy("id"), "id", ranges=64)).count() == 0


def test_columns_equal_those_of_the_join(spark):
    left, right = tables(spark, [1], [(1, 2)])
    got = dg.validate_by_digests(left, right, "id").drop("n_ranges_joined")
    assert got.columns == validate_embeddings(left, right, "id").columns
    assert [f.dataType for f in got.schema] == [f.dataType for f in validate_embeddings(left, right, "id").schema]
