"""Stored sketches: merged counts stay within their bound, whatever the parts."""

import random

import pytest

from folio.operators import sketches as sk
from folio.operators.quality import profile
from folio.operators.sketches import SketchTable
from tests.conftest import plan_text

SCHEMA = "day int, a string, b long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def made(n=20_000, seed=2):
    rnd = random.Random(seed)
    return [(rnd.choice([None, 1, 2, 3]) if rnd.random() < 0.6 else 1, rnd.choice([None, f"v{rnd.randrange(4000)}"]), rnd.randrange(9000)) for _ in range(n)]


def near(got, want):
    return abs(got - want) <= sk.error() * want


def test_estimates_are_within_the_bound_for_any_split(spark, tmp_dir):
    rows = made()
    exact = profile(frame(spark, rows), distinct=["a", "b"], missing=["a", "b"]).first()
    for i, size in enumerate((20_000, 7_000)):
        table = SketchTable(spark, f"{tmp_dir}/t{i}", ["a", "b"])
        for at in range(0, len(rows), size):
            table.deliver(frame(spark, rows[at:at + size]), f"d{at}")
        (got,) = table.estimates().collect()
        assert (got.n_rows, got.n_missing_a, got.n_missing_b) == (exact.n_rows, exact.n_missing_a, exact.n_missing_b)
        assert near(got.n_distinct_a, exact.n_distinct_a) and near(got.n_distinct_b, exact.n_distinct_b)


def test_days_are_put_together_and_replays_change_nothing(spark, tmp_dir):
    rows = made(6_000)
    table = SketchTable(spark, f"{tmp_dir}/t", ["a", "b"], by=["day"])
    table.deliver(frame(spark, rows[:4_000]), "one")
    table.deliver(frame(spark, rows[3_000:]), "two")  # a thousand values come twice
    first = sorted(map(str, table.estimates().collect()))
    table.deliver(frame(spark, rows[3_000:]), "two")
    assert sorted(map(str, table.estimates().collect())) == first and len(table.parts()) == 2
    by_day = {r.day: r for r in table.estimates().collect()}
    assert set(by_day) == {None, 1, 2, 3}
    for day, r in by_day.items():
        assert near(r.n_distinct_b, len({b for d, _, b in rows if d == day}))
    (whole,) = table.estimates(by=[]).collect()
    assert whole.n_rows == 7_000 and near(whole.n_distinct_a, len({a for _, a, _ in rows if a}))
    (some,) = table.estimates(by=[], names=["one"]).collect()
    assert some.n_rows == 4_000
    assert table.estimates(names=["none"]) is None
    with pytest.raises(ValueError):
        table.estimates(by=["a"])
    with pytest.raises(ValueError):
        table.deliver(frame(spark, rows[:1]), "../x")


def test_overlap_of_two_stages(spark):
    one = sk.sketch(frame(spark, [(1, f"v{i}", None) for i in range(3_000)]), ["a", "b"])
    other = sk.sketch(frame(spark, [(1, f"v{i}", 7) for i in range(2_000, 6_000)]), ["a", "b"])
    got = {r.column: r for r in sk.overlap(one, other, ["a", "b"]).collect()}
    assert near(got["a"].n_union, 6_000) and abs(got["a"].n_shared - 1_000) <= 3 * sk.error() * 6_000
    assert (got["b"].n_one, got["b"].n_other, got["b"].n_shared) == (0, 1, 0)


def test_empty_and_unfinished_deliveries(spark, tmp_dir):
    table = SketchTable(spark, f"{tmp_dir}/t", ["a"])
    assert table.estimates() is None and table.parts() == []
    table.deliver(frame(spark, []), "none")
    assert table.estimates().first().asDict() == {"n_rows": 0, "n_distinct_a": 0, "n_missing_a": 0}
    sk.sketch(frame(spark, made(10)), ["a"]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/delivery-cut")
    assert table.estimates().first().n_rows == 0
    table.deliver(frame(spark, [(1, None, 1)] * 30 + [(1, "x", 1)] * 30), "some")
    assert table.estimates().first().asDict() == {"n_rows": 60, "n_distinct_a": 1, "n_missing_a": 30}
    grouped = SketchTable(spark, f"{tmp_dir}/g", ["a"], by=["day"])
    grouped.deliver(frame(spark, []), "none")
    assert grouped.estimates().collect() == []


def test_a_hot_group_is_sketched_before_the_shuffle(spark):
    plan = plan_text(sk.sketch(frame(spark, made(50)), ["a"], by=["day"]), "simple")
    # Printed from the top: the merge, the shuffle, the sketches of each task.
    assert plan.index("hll_sketch_agg") < plan.index("Exchange") < plan.index("partial_hll_sketch_agg")
    assert "Window" not in plan and "Expand" not in plan
