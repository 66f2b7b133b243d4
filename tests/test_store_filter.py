"""The store's key filter: exact, mergeable, and fewer files read."""

import pytest
from pyspark.sql import functions as F

from folio.operators import store_filter as sf
from folio.operators.store import append_to_store

SCHEMA = "row_pos long, book_key string, title string"


def rows(spark, keys, start=0):
    return spark.createDataFrame([(start + i, k, f"t{start + i}") for i, k in enumerate(keys)], SCHEMA)


def held(df):
    return sorted(((r.book_key or "", r.row_pos) for r in df.collect()))


def keys(lo, hi):
    return [f"k{i:05d}" for i in range(lo, hi)]


def test_same_store_as_the_plain_append(spark, tmp_dir):
    steps = [keys(0, 400) + [None, None], keys(300, 700) + keys(300, 320), keys(0, 700), keys(5000, 5300) + [None], ["k00001"] * 500]
    for i, k in enumerate(steps):
        plain = append_to_store(spark, rows(spark, k, 1000 * i), f"{tmp_dir}/plain")
        mine = sf.append_filtered(spark, rows(spark, k, 1000 * i), f"{tmp_dir}/mine")
        assert held(mine) == held(plain)
    with pytest.raises(ValueError):
        sf.append_filtered(spark, rows(spark, []), f"{tmp_dir}/mine")


def test_files_without_a_candidate_key_are_not_read(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    for i in range(4):
        store = sf.append_filtered(spark, rows(spark, keys(1000 * i, 1000 * i + 600), 1000 * i), path)
    n = len(store.inputFiles())
    read = []
    # New keys only: at most a few files by chance; then a handful of old ones.
    sf.insert_filtered(spark, rows(spark, keys(90000, 90200)), path, read=read)
    assert n >= 4 and len(read) == 0
    read.clear()
    got = sf.insert_filtered(spark, rows(spark, keys(2000, 2010)), path, read=read)
    assert got.count() == 0 and len(read) == n // 4
    replay = sf.append_filtered(spark, rows(spark, keys(0, 600)), path)
    assert replay.count() == 2400


def test_a_file_without_filter_is_read_and_gets_one(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    sf.append_filtered(spark, rows(spark, keys(0, 50)), path)
    rows(spark, keys(50, 80), 50).write.mode("append").parquet(path)  # a failed append: no filter
    assert sf.append_filtered(spark, rows(spark, keys(40, 100), 100), path).count() == 100
    assert not sf._without_filter(spark, path)


def test_filters_hold_all_keys_merge_and_rarely_err(spark):
    df = spark.createDataFrame([(k, f"f{i % 3}") for i, k in enumerate(keys(0, 3000))], "k string, file string")
    filters = sf.build_filters(df, "k", "file").cache()
    found = sf.may_hold(df.select("k"), "k", filters)
    assert df.join(found, ["k", "file"], "left_anti").count() == 0
    wrong = sf.may_hold(rows(spark, keys(50000, 60000)).select(F.col("book_key").alias("k")), "k", filters).count()
    assert wrong <= 0.0005 * 3 * 10000
    both = sf.build_filters(df.where("file != 'f2'").withColumn("file", F.lit("x")), "k", "file")
    size = filters.agg({"blocks": "max"}).first()[0]
    if both.agg({"blocks": "max"}).first()[0] == size:
        one = sf.merged(filters.where("file != 'f2'")).orderBy("block").collect()
        assert [tuple(r) for r in one] == [tuple(r) for r in both.drop("file").orderBy("block").collect()]
    again = sf.merged(filters.where("file = 'f0'").unionByName(filters.where("file = 'f0'")))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, filters.where("file = 'f0'").drop("file").collect()))
    hot = spark.createDataFrame([("same", "f")] * 1000 + [(None, "f")], "k string, file string")
    assert sf.build_filters(hot, "k", "file").count() == 1
