"""Tiered enrichment, insert-or-ignore store, resume."""

import json
import os

import pytest

from conftest import SF_ORACLE
from folio.operators.enrichment import enrich
from folio.operators.store import append_to_store, insert_or_ignore, to_store_rows


def meta_doc(title, isbns=(), authors=None):
    ids = [{"type": t, "identifier": i} for t, i in isbns]
    return json.dumps({"title": title, "authors": authors, "industryIdentifiers": ids,
                       "publishedDate": "2001", "description": "  d  ", "publisher": "P"})


@pytest.fixture()
def small(spark):
    records = spark.createDataFrame(
        [
            (1, "r1", "alpha", "ann", "0306406152", "1", "c", "10"),
            (2, "r2", "beta", "bob", "9999999999", "2", "c", "20"),
            (3, "r3", "gamma", None, None, "3", "c", "30"),
            (4, "r4", "delta", "dan", None, "4", "c", "40"),
        ],
        "row_pos int, record_id string, title string, author_editor string, isbn string, "
        "accession_no string, class_no_book_no string, pages string",
    )
    meta = spark.createDataFrame(
        [
            (10, "0306406152", "x", meta_doc("  Alpha  Book ", [("OTHER", "o"), ("ISBN_10", "0306406152"), ("ISBN_13", "978")], ["A"])),
            (11, "0306406152", "x", meta_doc("late duplicate")),
            (12, None, "beta", meta_doc("Beta", [("ISBN_13", "9780000000001")], ["B", "bob"])),
            (13, None, "gamma", meta_doc("Gamma")),
        ],
        "meta_pos int, isbn_key string, title_key string, info_json string",
    )
    return records, meta


def test_tiers_and_shapes(spark, small):
    records, meta = small
    out = {r["row_pos"]: r for r in enrich(records, meta, carry=("row_pos",)).collect()}
    assert out[1]["match_tier"] == "isbn" and out[1]["title"] == "Alpha Book"
    assert out[1]["isbn"] == "0306406152"  # first ISBN-typed identifier in array order
    assert out[1]["summary"] == "d" and out[1]["authors"] == ["A"]
    assert out[2]["match_tier"] == "title" and out[2]["isbn"] == "9780000000001"
    assert out[3]["status"] == "FOUND" and out[3]["isbn"] is None
    assert out[4]["status"] == "MISSING" and out[4]["title"] == "delta" and out[4]["authors"] is None
    assert out[4]["book_key"] == "NOISBN|delta"


def test_title_author_tier(spark, small):
    records, meta = small
    out = {r["row_pos"]: r for r in enrich(records, meta, carry=("row_pos",), use_author=True).collect()}
    assert out[2]["match_tier"] == "title_author"  # 'bob' is a listed author of 'beta'
    assert out[3]["match_tier"] == "title"  # no author -> title only


def test_found_plus_missing_equals_total(spark):
    from folio.plans.enrichment_queries import enriched_df

    e = enriched_df(spark, SF_ORACLE)
    stats = {r["status"]: r["count"] for r in e.groupBy("status").count().collect()}
    assert sum(stats.values()) == e.count() == 797
    assert e.select("record_id").distinct().count() == 797


def test_insert_or_ignore_idempotent(spark, tmp_dir, small):
    records, meta = small
    rows = to_store_rows(enrich(records, meta, carry=("row_pos",)), keep=["row_pos"])
    path = os.path.join(tmp_dir, "books")
    first = append_to_store(spark, rows, path).count()
    assert first == 4
    again = append_to_store(spark, rows, path).count()
    assert again == 4  # existing keys win; nothing new appended


def test_null_keys_never_conflict(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "k"), (4, "k")], "row_pos int, book_key string")
    existing = spark.createDataFrame([("k",)], "book_key string")
    assert sorted(r[0] for r in insert_or_ignore(df, existing).select("row_pos").collect()) == [1, 2]


def test_empty_input_is_error(spark, tmp_dir):
    empty = spark.createDataFrame([], "row_pos int, book_key string")
    with pytest.raises(ValueError):
        append_to_store(spark, empty, os.path.join(tmp_dir, "b"))


def test_salted_title_join_equals_plain(spark):
    from pyspark.sql import functions as F

    from folio.plans.cleaning_queries import clean_catalog_df
    from folio.sources.catalog_views import catalog_meta

    # A hot title: every record without ISBN shares one title.
    clean = clean_catalog_df(spark, SF_ORACLE).withColumn(
        "title", F.when(F.col("isbn").isNull(), F.lit("en 1 volume")).otherwise(F.col("title"))
    )
    meta = catalog_meta(spark, SF_ORACLE)
    plain = enrich(clean, meta, carry=("row_pos",))
    salted = enrich(clean, meta, carry=("row_pos",), skew_salt=8)
    cols = plain.columns
    assert sorted(map(tuple, plain.select(*cols).collect()), key=str) == sorted(
        map(tuple, salted.select(*cols).collect()), key=str)


def test_adaptive_skew_join_splits_hot_title(spark):
    from pyspark.sql import functions as F

    from conftest import plan_text
    from folio.plans.cleaning_queries import clean_catalog_df
    from folio.sources.catalog_views import catalog_meta

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        clean = clean_catalog_df(spark, SF_ORACLE).withColumn(
            "title", F.when(F.col("isbn").isNull(), F.lit("en 1 volume")).otherwise(F.col("title"))
        )
        out = enrich(clean, catalog_meta(spark, SF_ORACLE), carry=("row_pos",))
        rows = out.collect()
        final = plan_text(out, "simple").split("== Initial Plan ==")[0]
        assert len(rows) == 797
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_clustered_store_files_cover_disjoint_key_ranges(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    rows = spark.range(3000).select(
        F.col("id").alias("row_pos"), F.format_string("k%05d", (F.col("id") * 7919) % 3000).alias("book_key")
    ).repartition(6)
    path = os.path.join(tmp_dir, "clustered")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep 4 files to inspect
    try:
        stored = append_to_store(spark, rows, path, cluster_by_key=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert stored.count() == 3000
    ranges = []
    for f in glob.glob(os.path.join(path, "*.parquet")):
        stats = pq.ParquetFile(f).metadata.row_group(0).column(1).statistics
        ranges.append((stats.min, stats.max))
    ranges.sort()
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
