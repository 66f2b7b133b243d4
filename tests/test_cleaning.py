"""Keep-first dedupe, two-tier cleaning, duplicates."""

from pyspark.sql import functions as F

from folio.operators.cleaning import clean, dedupe_catalog, duplicates, keep_first


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_keep_first_groups_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (2, None, "b"), (3, "k", "c"), (4, "k", "d")], "row_pos int, k string, v string"
    )
    assert rows(keep_first(df, ["k"]), "row_pos", "v") == [(1, "a"), (3, "c")]
    assert rows(keep_first(df, ["k"], null_keys="keep"), "row_pos", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_keep_first_hot_key_across_partitions(spark):
    # One key holds a third of all rows, spread over many partitions.
    n = 30_000
    df = spark.range(n).repartition(16).select(
        F.col("id").alias("row_pos"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
    )
    out = keep_first(df, ["k"])
    assert out.count() == n - n // 3 + 1
    assert out.where("k = 'hot'").first()["row_pos"] == 0


def test_result_independent_of_partitioning(spark):
    df = spark.range(5000).select(
        F.col("id").alias("row_pos"), (F.col("id") % 37).cast("string").alias("isbn"),
        F.lit("t").alias("title"), F.lit(None).cast("string").alias("author_editor"),
    )
    a = rows(dedupe_catalog(df.repartition(1)), "row_pos")
    b = rows(dedupe_catalog(df.repartition(13)), "row_pos")
    assert a == b == [(i,) for i in range(37)]


def test_clean_two_tier(spark):
    data = [
        (0, " The  Book ", "Ann", "0-306-40615-2", "1999"),
        (1, "the book", "Bob", "0306406152", "2001"),  # same ISBN -> dropped
        (2, "Other", None, None, "1499"),
        (3, "other", None, "bad", "n.d."),  # same (title, author) without ISBN -> dropped
        (4, None, "X", "9780306406157", "2000"),  # no title -> dropped
        (5, "   ", None, None, None),  # blank title survives
    ]
    df = spark.createDataFrame(data, "row_pos int, title string, author_editor string, isbn string, year string")
    out = {r["row_pos"]: r for r in clean(df).collect()}
    assert sorted(out) == [0, 2, 5]
    assert out[0]["title"] == "the book" and out[0]["isbn"] == "0306406152" and out[0]["year"] == 1999.0
    assert out[2]["year"] is None and out[5]["title"] == ""
    assert len({r["record_id"] for r in out.values()}) == 3


def test_duplicates_lists_later_occurrences(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None), (6, "a")], "row_pos int, t string")
    assert rows(duplicates(df, "t"), "row_pos") == [(3,), (5,), (6,)]


def test_flagship_counts(spark):
    from conftest import SF_ORACLE
    from folio.plans.cleaning_queries import clean_catalog_df

    clean_df = clean_catalog_df(spark, SF_ORACLE)
    assert clean_df.count() == clean_df.select("record_id").distinct().count() == 797
    with_isbn = clean_df.where("isbn IS NOT NULL").count()
    assert with_isbn + clean_df.where("isbn IS NULL").count() == 797
