"""Pages from the stored index equal those of ``browse``."""

import random
import re

import pytest

from folio.operators.paging import POSITION, RANGE, PageIndex
from tests.conftest import plan_text

SCHEMA = "k string, n int, body string"


def made(count=500, seed=4):
    rnd = random.Random(seed)
    rows = {(None if rnd.random() < 0.05 else f"k{rnd.randrange(30):02d}", rnd.randrange(200)) for _ in range(count)}
    return [(k, n, f"body {k} {n}") for k, n in rows]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return PageIndex.build(df, str(tmp_path_factory.mktemp("pages") / "i"), ["k", "n"], ranges=7), in_order(rows)


def held(df):
    return [tuple(r) for r in df.collect()]


def test_every_page_equals_the_sorted_rows(index):
    ix, rows = index
    for size in (1, 40, 1000):
        for skip in (0, 1, 39, 200, len(rows) - 1, len(rows), len(rows) + 10):
            assert held(ix.page(skip, size)) == rows[skip:skip + size]
    assert held(ix.page(0, 0)) == []


def test_seeking_walks_through_all_rows(index):
    ix, rows = index
    seen, key = held(ix.page(0, 90)), None
    while True:
        key = seen[-1][:2]
        more = held(ix.seek(key, 90))
        if not more:
            break
        seen += more
    assert seen == rows
    # Keys that are not there, before everything, and with NULL.
    want = [r for r in rows if r[0] is not None and (r[0], r[1]) > ("k07", -5)]
    assert held(ix.seek(("k07", -5), 30)) == want[:30]
    assert held(ix.seek((None, -1), 25)) == rows[:25]
    assert held(ix.seek(("z", 0), 25)) == []


def test_an_index_is_opened_again(spark, index):
    ix, rows = index
    again = PageIndex(spark, ix.path, ["k", "n"])
    assert held(again.page(100, 5)) == rows[100:105]
    assert spark.range(1).select(again.total().alias("t")).first().t == len(rows)


def test_a_page_reads_one_range(index):
    ix, rows = index
    for page, pushed in ((ix.page(10, 5), f"{POSITION},"), (ix.seek(("k12", 3), 5), "GreaterThanOrEqual(k,")):
        plan = plan_text(page)
        filters = re.search(r"PartitionFilters: (.*)", plan).group(1)
        assert re.search(rf"{RANGE}#\d+ (=|IN)", filters) and pushed in re.search(r"PushedFilters: (.*)", plan).group(1)
        # The page's few rows are all that is sorted.
        assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "Window" not in plan
    one = ix._ranges.where("start = 0").first()
    assert len(set(r[0] for r in ix._rows.where(f"{RANGE} = {one[RANGE]}").selectExpr("_metadata.file_path").collect())) == 1


def test_empty_table_and_bad_arguments(spark, tmp_dir):
    ix = PageIndex.build(spark.createDataFrame([], SCHEMA), f"{tmp_dir}/e", ["k", "n"])
    assert held(ix.page(0, 5)) == [] and held(ix.seek(("a", 1))) == [] and ix.page().columns == ["k", "n", "body"]
    assert spark.range(1).select(ix.total().alias("t")).first().t == 0
    with pytest.raises(ValueError):
        ix.page(-1)
    with pytest.raises(ValueError):
        ix.seek(("a",))
    with pytest.raises(ValueError):
        PageIndex(spark, f"{tmp_dir}/none", ["k"])
