"""Keep-first over deliveries equals one keep-first over everything."""

import itertools
import random

import pytest

from folio.operators.cleaning import keep_first
from folio.operators.increments import BUCKET, FirstRows, bucket_of
from tests.conftest import plan_text

SCHEMA = "k1 string, k2 string, row_pos long, body string"


def made(n=300, seed=5):
    rnd = random.Random(seed)
    keys = [None, "", "a", "b", "hot"] + [f"k{i}" for i in range(40)]
    return [(("hot" if rnd.random() < 0.3 else rnd.choice(keys)), rnd.choice([None, "x", "y"]), i, f"body {i}") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[2])


@pytest.mark.parametrize("null_keys", ["group", "keep"])
def test_any_order_of_arrival_gives_the_global_result(spark, tmp_dir, null_keys):
    rows = made()
    want = held(keep_first(frame(spark, rows), ["k1", "k2"], null_keys=null_keys))
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    cuts = [shuffled[:20], shuffled[20:200], shuffled[200:]]
    for i, order in enumerate(itertools.islice(itertools.permutations(range(3)), 0, 6, 2)):
        table = FirstRows(spark, f"{tmp_dir}/t{i}", ["k1", "k2"], null_keys=null_keys, buckets=4)
        for d in order:
            table.deliver(frame(spark, cuts[d]), f"d{d}")
        assert held(table.rows()) == want
        assert table.rows().columns == SCHEMA.replace(" string", "").replace(" long", "").split(", ")


@pytest.mark.parametrize("null_keys", ["group", "keep"])
def test_replays_compaction_and_unfinished_parts_change_nothing(spark, tmp_dir, null_keys):
    rows = made(120)
    want = held(keep_first(frame(spark, rows), ["k1", "k2"], null_keys=null_keys))
    table = FirstRows(spark, f"{tmp_dir}/t", ["k1", "k2"], null_keys=null_keys, buckets=4)
    table.deliver(frame(spark, rows[60:]), "late")
    table.deliver(frame(spark, rows[:60]), "early")
    table.deliver(frame(spark, rows[:60]), "early")  # the same name
    table.deliver(frame(spark, rows[30:90]), "again")  # other names, rows that are there
    assert held(table.rows()) == want
    # A compaction that stopped before it deleted what it had read.
    table._write(table._least(table._stored(table.parts())), f"{table.path}/merged-1")
    assert held(table.rows()) == want and len(table.parts()) == 4
    table.compact()
    assert held(table.rows()) == want and [p.rsplit("/", 1)[1] for p in table.parts()] == ["merged-2"]
    table.compact()  # nothing to do
    assert len(table.parts()) == 1
    # A part without success mark was not finished.
    frame(spark, [("zz", "zz", -1, "unfinished")]).selectExpr("*", f"0 as {BUCKET}").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(BUCKET).parquet(f"{table.path}/delivery-broken")
    assert held(table.rows()) == want
    table.deliver(frame(spark, [("zz", "zz", -1, "now finished")]), "broken")
    assert held(table.rows())[0] == ("zz", "zz", -1, "now finished")


def test_effect_names_new_and_earlier_rows(spark, tmp_dir):
    table = FirstRows(spark, f"{tmp_dir}/t", ["k1"], null_keys="keep", buckets=4)
    assert table.rows() is None and table.lookup(frame(spark, made(3))) is None
    first = frame(spark, [("a", None, 10, "x"), ("b", None, 20, "x"), (None, None, 30, "x")])
    assert {r.effect for r in table.effect(first).collect()} == {"new"}
    table.deliver(first, "one")
    second = frame(spark, [("a", None, 5, "y"), ("a", None, 6, "y"), ("b", None, 25, "y"), ("c", None, 1, "y"),
                           (None, None, 30, "x"), (None, None, 31, "y")])
    got = {(r.k1, r.row_pos): r.effect for r in table.effect(second).collect()}
    assert got == {("a", 5): "earlier", ("b", 25): "none", ("c", 1): "new", (None, 30): "none", (None, 31): "new"}


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_dir):
    rows = made(400)
    table = FirstRows(spark, f"{tmp_dir}/t", ["k1", "k2"], buckets=16)
    table.deliver(frame(spark, rows[200:]), "b")
    table.deliver(frame(spark, rows[:200]), "a")
    wanted = [("hot", "x", 0, ""), (None, None, 0, ""), ("not there", "x", 0, "")]
    keys = {(r[0], r[1]) for r in wanted}
    got = table.lookup(frame(spark, wanted))
    assert held(got) == [r for r in held(table.rows()) if (r[0], r[1]) in keys] and got.count() == 2
    # One key: the scan lists the files of its bucket only.
    one = frame(spark, wanted[:1])
    mine = one.select(bucket_of(["k1", "k2"], 16).alias("b")).first().b
    plan = plan_text(table.lookup(one))
    assert plan.count(f"({BUCKET}#") >= 2 and f" = {mine})" in plan and "PartitionFilters" in plan


def test_empty_deliveries_and_bad_arguments(spark, tmp_dir):
    table = FirstRows(spark, f"{tmp_dir}/t", ["k1"])
    table.deliver(frame(spark, []), "none")
    assert table.rows() is None
    table.deliver(frame(spark, [("a", None, 1, "x")] * 50), "one")  # repeated rows are one
    assert held(table.rows()) == [("a", None, 1, "x")]
    with pytest.raises(ValueError):
        table.deliver(frame(spark, []), "../x")
    with pytest.raises(ValueError):
        FirstRows(spark, tmp_dir, ["k1"], null_keys="drop")


def test_delivering_reads_nothing_stored(spark, tmp_dir):
    """The plan of a delivery has no scan of the table: its cost is the delivery's."""
    table = FirstRows(spark, f"{tmp_dir}/t", ["k1"], buckets=4)
    table.deliver(frame(spark, made(50)), "a")
    plan = plan_text(table._least(frame(spark, made(50)).withColumn(BUCKET, table._bucket())))
    assert "Scan parquet" not in plan and plan.count("Exchange") >= 1
