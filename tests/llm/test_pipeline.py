"""The pipeline against brute-force versions of its stages, on small tables."""

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from folio.llm import decontam
from tests.conftest import SF_SMALL
from tests.llm.helpers import components, cut_repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage over the whole smallest tables."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [("documents", docs.collect(), docs.columns)]
    for name, fn in corpus_pipeline.STAGES:
        frame = fn(spark, docs, SF_SMALL)
        rows = frame.collect()
        out.append((name, rows, frame.columns))
        docs = spark.createDataFrame(rows, frame.schema)
    return out


def test_columns_and_order(stages):
    assert [s[0] for s in stages] == ["documents", "language_id", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    assert all(s[2] == stages[0][2] for s in stages[:-1])


def test_language_keeps_clean_documents(stages):
    before, after = stages[0][1], stages[1][1]
    kept = {r.doc_id: r for r in after}
    gone = [r for r in before if r.doc_id not in kept]
    assert len(gone) <= 0.01 * len(before)
    assert all(kept[r.doc_id] == r for r in before if r.doc_id in kept)


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after = stages[1][1], stages[2][1]
    want = components([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(d for d, c in want.items() if d == c)


def test_repeats_are_cut(stages):
    before, after = stages[2][1], {r.doc_id: r for r in stages[3][1]}
    assert len(after) == len(before)
    for r, (gone, _, left) in zip(before, cut_repeats([r.text for r in before], corpus_pipeline.PASSAGE)):
        text = left.decode("utf-8", "ignore") if gone else r.text
        assert after[r.doc_id].text == text
        assert after[r.doc_id].n_chars == (len(text) if gone else r.n_chars)


def test_contaminated_documents_go(stages):
    before, after = stages[3][1], stages[4][1]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(r.doc_id, r.text) for r in before])
    con.execute(f"create view benchmark as select * from '{SF_SMALL}/benchmark.parquet'")
    bad = {r[0] for r in con.execute(decontam.oracle_sql()).fetchall()}
    assert bad and {r.doc_id for r in after} == {r.doc_id for r in before} - bad


def test_every_token_is_packed_once(stages):
    before, after = stages[4][1], stages[5][1]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before}
    got, seqs = {}, {}
    for r in after:
        got.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, n in want.items():
        spans = sorted(got.pop(d))
        assert [a for a, _ in spans] == np.cumsum([0, *(k for _, k in spans)])[:-1].tolist() and sum(k for _, k in spans) == n
    assert not got
    for spans in seqs.values():
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0, *(k for _, k in spans)])[:-1].tolist() and sum(k for _, k in spans) <= 1024


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    pieces = lambda rows: sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert pieces(got) == pieces(stages[-1][1])


def test_stages_take_null_repeated_and_no_rows(spark):
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "nu"]) + str(i) for i in range(50))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (None, "words without an id here", None, None, None), (2, None, None, "s", None),
            (3, "", "en", None, 0), (4, text + " and more", " ", "s", 1), (5, "77 88", "en", "s", 5), (6, "other words that stand alone in here", None, "s", 36)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, fn in corpus_pipeline.STAGES:
        out = fn(spark, docs, SF_SMALL)
        held = out.collect()
        empty = fn(spark, docs.limit(0), SF_SMALL)
        assert empty.collect() == [] and empty.columns == out.columns, name
        if name != "packing":
            docs = spark.createDataFrame(held, DOCS)
        if name == "language_id":
            assert sorted((r.doc_id or -1) for r in held) == [-1, 1, 1, 4, 6] and all(r.lang for r in held)
        if name == "minhash_near_dedup":
            assert sorted((r.doc_id or -1) for r in held) == [-1, 1, 6]
    assert {r.doc_id for r in held} == {None, 1, 6}
