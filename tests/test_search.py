"""Search, browse and paging."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from folio.operators.search import browse, browse_deep, lookup_isbn, page_results, search, search_any, with_pages


@pytest.fixture()
def books(spark):
    return spark.createDataFrame(
        [(1, "Data 100% Guide", "x_y"), (2, "data science", None), (3, "C:\\path", "pub"), (4, None, "Data")],
        "id int, title string, publisher string",
    )


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_search_rules(books):
    assert ids(search(books, "title", "DATA")) == [1, 2]
    assert ids(search(books, None, "x")) == [1, 2, 3, 4]  # no-op without both
    assert ids(search(books, "title", "")) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        search(books, "summary", "x")
    assert ids(search(books, "title", "100%")) == [1]
    assert ids(search(books, "title", "d_ta")) == [1, 2]  # '_' is a wildcard, as in the reference
    assert ids(search(books, "title", "d_ta", literal=True)) == []
    assert ids(search(books, "title", "c:\\p")) == [3]  # backslash is literal


def test_search_any(books):
    assert ids(search_any(books, ["title", "publisher"], "data")) == [1, 2, 4]


def test_browse_page_and_total(spark):
    df = spark.range(95).select(F.col("id").alias("k"), (F.col("id") % 2).alias("odd"))
    page = browse(df, ["k"], skip=20, limit=10).collect()
    assert [r["k"] for r in page] == list(range(20, 30)) and page[0]["total"] == 95
    assert browse(df, ["k"], skip=90, limit=10).count() == 5


def test_with_pages_matches_brute_force(spark):
    n, size = 1234, 10
    df = spark.range(n).select((F.col("id") * 7 % n).alias("k")).repartition(9)
    out = sorted((r["k"], r["row_number"], r["page"], r["total_pages"]) for r in with_pages(df, ["k"], size).collect())
    assert out == [(k, k + 1, k // size + 1, (n + size - 1) // size) for k in range(n)]


def test_lookup_isbn_pushdown(spark, tmp_dir):
    path = f"{tmp_dir}/b"
    spark.createDataFrame([("0306406152", "a"), ("123", "b")], "isbn string, t string").write.parquet(path)
    df = lookup_isbn(spark.read.parquet(path), "0-306-40615-2")
    assert [r["t"] for r in df.collect()] == ["a"]
    assert "PushedFilters: [IsNotNull(isbn), EqualTo(isbn,0306406152)]" in plan_text(df, "simple")


def numbered_frame(spark, n=200_000):
    """Distinct keys in mixed order with two payload columns."""
    k = F.col("id") * 7919 % n
    return spark.range(n).select(k.alias("k"), F.concat(F.lit("p"), k).alias("p"), (k * 2).alias("q")).repartition(7)


def test_deep_page_with_payload_matches_shallow_page(spark):
    df = numbered_frame(spark)
    deep = browse_deep(df, ["k"], skip=150_000, limit=10).collect()
    assert deep == browse(df, ["k"], skip=150_000, limit=10).collect()
    assert [tuple(r) for r in deep] == [(k, f"p{k}", 2 * k, 200_000) for k in range(150_000, 150_010)]


def test_numbers_with_payload_are_exact(spark):
    out = with_pages(numbered_frame(spark), ["k"], 25)
    wrong = out.where((F.col("row_number") != F.col("k") + 1) | (F.col("page") != F.floor(F.col("k") / 25) + 1)
                      | (F.col("p") != F.concat(F.lit("p"), "k")) | (F.col("total_pages") != 8000))
    assert out.count() == 200_000 and wrong.count() == 0


def test_numbers_follow_null_and_composite_keys(spark):
    rows = [(None, 2, "b"), (None, 1, "a"), (1, None, "c"), (1, 5, "d"), (2, 0, "e")]
    out = with_pages(spark.createDataFrame(rows, "x int, y int, v string"), ["x", "y"], 2).collect()
    assert [(r["v"], r["row_number"], r["page"], r["total_pages"]) for r in sorted(out, key=lambda r: r["row_number"])] == [
        (v, i + 1, i // 2 + 1, 3) for i, v in enumerate("abcde")]


def test_empty_page_keeps_the_total(spark):
    df = spark.range(25).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    for page in (browse(df, ["k"], skip=100, limit=10), browse_deep(df, ["k"], skip=100, limit=10)):
        assert [tuple(r) for r in page.collect()] == [(None, None, 25)]
    assert [tuple(r) for r in browse(df.where("k < 0"), ["k"]).collect()] == [(None, None, 0)]


def test_results_are_paged_by_position_after_the_fetch(spark):
    df = spark.createDataFrame([(1, r) for r in (2, 3, 5, 9)], "qid int, rank int")
    out = {r["rank"]: (r["page"], r["total_pages"]) for r in page_results(df, size=2).collect()}
    assert out == {2: (1, 2), 3: (1, 2), 5: (2, 2), 9: (2, 2)}


def test_page_results_per_query(spark):
    rows = [(1, r) for r in range(1, 24)] + [(2, r) for r in range(1, 4)]
    df = spark.createDataFrame(rows, "qid int, rank int")
    out = {(r["qid"], r["rank"]): (r["page"], r["total_pages"]) for r in page_results(df, size=10).collect()}
    assert out[(1, 1)] == (1, 3) and out[(1, 11)] == (2, 3) and out[(1, 23)] == (3, 3)
    assert out[(2, 3)] == (1, 1)  # page size shrinks to the result count
