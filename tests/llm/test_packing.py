import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folio.llm import packing
from tests.conftest import SF_SMALL
from tests.llm.helpers import crowded, frame, sentence

PATH = public_tokenizers.path("byte_bpe_50k.json")


def first_fit(lengths, need, size):
    """Sequences that first-fit decreasing opens."""
    room = []
    for v, n in sorted(zip(lengths.tolist(), need.tolist()), reverse=True):
        for _ in range(n):
            at = next((i for i, r in enumerate(room) if r >= v), None)
            if at is None:
                room.append(size - v)
            else:
                room[at] -= v
    return len(room)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 60), min_size=1, max_size=25))
def test_patterns_pack_every_piece_near_the_bound(hist):
    lengths, need = np.array(sorted(hist)), np.array([hist[k] for k in sorted(hist)])
    patterns = packing.solve_patterns(lengths, need, 64)
    got = np.zeros(len(need), int)
    for p, times in patterns:
        assert sum(lengths[k] * a for k, a in p.items()) <= 64 and times > 0
        for k, a in p.items():
            got[k] += a * times
    assert (got == need).all()
    assert sum(t for _, t in patterns) <= first_fit(lengths, need, 64)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 200), min_size=1, max_size=25))
def test_first_fit_by_groups(hist):
    lengths, need = np.array(sorted(hist)), np.array([hist[k] for k in sorted(hist)])
    patterns = packing.first_fit(lengths, need, 64)
    got = np.zeros(len(need), int)
    for p, times in patterns:
        assert sum(lengths[k] * a for k, a in p.items()) <= 64
        for k, a in p.items():
            got[k] += a * times
    assert (got == need).all() and sum(t for _, t in patterns) == first_fit(lengths, need, 64)


def test_random_histograms_reach_the_bound():
    """200 histograms: never above first fit, and the linear program's bound
    (the least of the rounds) is reached within two sequences."""
    rng = np.random.default_rng(17)
    for t in range(200):
        lengths = np.sort(rng.choice(np.arange(1, 64), rng.integers(1, 40), replace=False))
        need = rng.integers(1, [5, 30, 80][t % 3], len(lengths))
        stats: dict = {}
        patterns = packing.solve_patterns(lengths, need, 64, stats=stats)
        n = sum(times for _, times in patterns)
        assert n <= first_fit(lengths, need, 64)
        assert n <= np.ceil(stats["bound"] * (1 + packing.GAP) - 1e-6) + 2, (t, n, stats)


def test_column_generation_beats_a_poor_start():
    lengths, need = np.array([20, 34, 44]), np.array([900, 900, 900])
    patterns = packing.solve_patterns(lengths, need, 64)
    # best: 44+20 fills a sequence; 34s stay alone
    assert sum(t for _, t in patterns) == 1800


def test_slots_do_not_overlap():
    lengths, need = np.array([3, 10, 30]), np.array([40, 25, 17])
    patterns = packing.solve_patterns(lengths, need, 64)
    table = packing.slots(lengths, patterns)
    used = {}
    for v, n in zip(lengths, need):
        rows = table[int(v)]
        for rank in range(n):
            first, copies, seq, off = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
            k = rank - first
            used.setdefault(seq + k // copies, []).append((off + k % copies * v, v))
    for spans in used.values():
        at = 0
        for off, v in sorted(spans):
            assert off == at
            at += v
        assert at <= 64


@pytest.mark.parametrize("text", [packing.PROBE, "", "  a  b ", "<|endoftext|> x", "naïve ÉÀ  日本語 \U0001f600", "\x00\x1c'll 've  \n\n 12345abc"])
def test_fast_ids_equal_those_of_tokenizers(text):
    slow = Tokenizer.from_file(PATH)
    assert list(packing.load_encoder(PATH)(text)) == slow.encode(text, add_special_tokens=False).ids


def check(rows, got, size=1024):
    slow = Tokenizer.from_file(PATH)
    want = {}
    for d, t in rows:
        ids = np.array(slow.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault(d, []).append(ids)
    by, seqs = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by) == set(want)
    for d, docs in want.items():
        pieces = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by[d])
        assert pieces == sorted((a, len(x[a:a + size]), zlib.crc32(x[a:a + size].tobytes()), len(x)) for x in docs for a in range(0, len(x), size))
    for spans in seqs.values():
        at = 0
        for off, length in sorted(spans):
            assert off == at and length > 0
            at += length
        assert at <= size
    return seqs


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 4)
    rng = random.Random(0)
    rows = [(1, None), (2, ""), (3, "x"), (4, sentence(rng, 4000)), (5, "same text"), (5, "same text"), (None, "no id"), (6, "<|endoftext|>"), (7, sentence(rng, 30))]
    check(rows, packing.pack(frame(spark, rows), PATH).collect())
    check(rows, packing.pack(crowded(spark, rows), PATH, size=64).collect(), 64)
    assert packing.pack(frame(spark, []), PATH).collect() == []


def test_documents_are_packed_with_little_padding(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.pack(docs, PATH).collect()
    seqs = check(rows, got)
    tokens = sum(r.length for r in got)
    assert len(seqs) * 1024 < 1.02 * tokens
