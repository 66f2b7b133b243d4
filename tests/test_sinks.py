"""Sinks: per-source output, versioned saves, embeddings."""

import os

from pyspark.sql import functions as F

from folio.sources.catalog_csv import read_catalog_csv
from folio.sources.sinks import (
    latest_version,
    read_embeddings,
    read_latest,
    save_enriched,
    write_embeddings,
    write_per_source,
)


def test_write_per_source(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for name, body in (("a.csv", "Title\nx\ny\n"), ("b.csv", "Title\nz\n")):
        with open(os.path.join(raw, name), "w") as f:
            f.write(body)
    df = read_catalog_csv(spark, raw).drop("file_path", "file_block_start", "row_pos")
    out = os.path.join(tmp_dir, "out")
    write_per_source(df, out)
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == ["_SUCCESS", "source_file=a.csv", "source_file=b.csv"]
    back = spark.read.option("header", True).csv(out)
    assert sorted((r["source_file"], r["Title"]) for r in back.collect()) == [
        ("a.csv", "x"), ("a.csv", "y"), ("b.csv", "z")]


def test_versioned_saves(spark, tmp_dir):
    base = os.path.join(tmp_dir, "enriched")
    assert latest_version(spark, base) is None
    df = spark.createDataFrame([("r1", "k1", "FOUND", ["a"])], "record_id string, book_key string, status string, authors array<string>")
    save_enriched(spark, df, base)
    save_enriched(spark, df.withColumn("status", F.lit("MISSING")), base)
    assert latest_version(spark, base) == 1
    latest = read_latest(spark, base).collect()
    assert len(latest) == 1 and latest[0]["status"] == "MISSING" and latest[0]["authors"] == ["a"]


def test_embeddings_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "emb")
    df = spark.createDataFrame([("r1", [0.5, 1.0]), ("r2", [0.0, 2.0])], "id string, v array<double>")
    write_embeddings(df, path, id_col="id", vec="v")
    back = {r["record_id"]: r["embedding"] for r in read_embeddings(spark, path).collect()}
    assert back == {"r1": [0.5, 1.0], "r2": [0.0, 2.0]}


def test_read_enriched_json_array(spark, tmp_dir):
    import json

    from folio.sources.sinks import read_enriched

    path = os.path.join(tmp_dir, "enriched.json")
    records = [
        {"record_id": "r1", "book_key": "1|a", "status": "FOUND", "authors": ["A", "B"], "pages": 200, "year": "2001"},
        {"record_id": "r2", "book_key": "NOISBN|b", "status": "MISSING", "authors": None, "subjects": None},
    ]
    with open(path, "w", encoding="utf-8") as f:
        json.dump(records, f, indent=2, ensure_ascii=False)
    rows = {r["record_id"]: r for r in read_enriched(spark, path, fmt="json_array").collect()}
    assert rows["r1"]["authors"] == ["A", "B"] and rows["r1"]["pages"] == "200"  # numbers read as text
    assert rows["r2"]["authors"] is None and rows["r2"]["title"] is None  # absent keys -> NULL


def test_only_committed_versions_count(spark, tmp_dir):
    import os

    from folio.sources.sinks import latest_version, save_enriched

    base = os.path.join(tmp_dir, "versions")
    assert latest_version(spark, base) is None
    df = spark.createDataFrame([("r", "k")], "record_id string, book_key string")
    save_enriched(spark, df, base)
    save_enriched(spark, df, base)
    assert latest_version(spark, base) == 1
    os.makedirs(os.path.join(base, "version=7"))  # a write that never ended
    with open(os.path.join(base, "version=7", "part-0.json"), "w") as f:
        f.write("{}")
    assert latest_version(spark, base) == 1
    assert save_enriched(spark, df, base).endswith("version=2") and latest_version(spark, base) == 2


def test_scratch_folders_need_a_shared_folder_off_a_local_master(spark, monkeypatch):
    from types import SimpleNamespace

    import pytest

    from folio import session

    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[3,2,1024]") and not session.is_local("spark://host:7077") and not session.is_local("yarn")
    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=SimpleNamespace(master="yarn")))


def test_scratch_folders_can_be_deleted(spark):
    from folio.session import delete_path, reliable_checkpoint, scratch_path
    from folio import session

    df = reliable_checkpoint(spark.range(5).toDF("id"), "gone")
    path = session._SCRATCH[-1]
    assert df.count() == 5
    delete_path(spark, path)
    assert path not in session._SCRATCH and scratch_path(spark, "x") != path
