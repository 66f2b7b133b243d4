import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import suffix_dedup as sd
from tests.llm.helpers import crowded, cut_repeats, frame


@settings(max_examples=60, deadline=None)
@given(st.integers(8, 90), st.data())
def test_sorted_windows_equal_counting(length, data):
    text = data.draw(st.text(alphabet="ab", min_size=length, max_size=4 * length)).encode() * data.draw(st.integers(1, 3))
    raw = np.frombuffer(text, np.uint8)
    starts = np.arange(len(raw) - length + 1)
    seen = [text[i:i + length] for i in starts]
    assert sd.repeated_windows(raw, starts, length).tolist() == [seen.count(s) > 1 for s in seen]


def test_cover_reaches_every_difference():
    for period in (1, 2, 4, 8, 16, 32):
        d = sd.difference_cover(period)
        assert {(a - b) % period for a in d for b in d} == set(range(period))


def texts(seed=5):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared, hot = word(70), word(90)
    out = [word(rng.randint(0, 200)) for _ in range(30)]
    out += [word(20) + shared[rng.randint(0, 10):] + word(30) for _ in range(6)]
    out += [word(5) + hot + word(rng.randint(0, 5)) for _ in range(40)]
    out += [word(10) + shared + word(3) + shared, "z" * 150, "ab" * 80, None, "", "x", hot, hot]
    return out


def check(got, rows, length):
    want = {d: r for (d, _), r in zip(rows, cut_repeats([t for _, t in rows], length))}
    assert len(got) == len(rows)
    for r in got:
        gone, runs, left = want[r.doc_id]
        assert (r.n_removed, r.n_spans, bytes(r.kept_bytes)) == (gone, runs, left)
        assert r.n_bytes == gone + len(left) and len(r.removed) == runs


@pytest.mark.parametrize("length", [16, 40])
def test_cut_texts_equal_brute_force(spark, length):
    rows = list(enumerate(texts()))
    check(sd.remove_repeats(frame(spark, rows), length).collect(), rows, length)


def test_buckets_beyond_a_block_and_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK_BYTES", 300)
    monkeypatch.setattr(sd, "LARGE_BYTES", 300)
    monkeypatch.setattr(sd, "PIECE_BYTES", 64)
    monkeypatch.setattr(sd, "BROADCAST_BUCKETS", -1)
    monkeypatch.setattr(sd, "BROADCAST_ENTRIES", -1)
    rows = list(enumerate(texts(9)))
    check(sd.remove_repeats(crowded(spark, rows), 24).collect(), rows, 24)


@pytest.mark.parametrize("length,passage", [(40, 16), (24, 20)])
def test_shorter_passages_beside(spark, length, passage):
    rows = list(enumerate(texts(4)))
    got = sd.remove_repeats(frame(spark, rows), length, passage).collect()
    check(got, rows, length)
    want = {d: r[0] for (d, _), r in zip(rows, cut_repeats([t for _, t in rows], passage))}
    assert {r.doc_id: r.n_passage for r in got} == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "abcdefghij" * 3 + "q"), (1, "abcdefghij" * 3 + "q"), (None, "0123456789abcdef"), (None, "xx0123456789abcdef"), (3, None)]
    got = sd.remove_repeats(frame(spark, rows), 16).collect()
    left = sorted((r.doc_id or -1, bytes(r.kept_bytes)) for r in got)
    assert left == [(-1, b""), (-1, b"xx"), (1, b""), (1, b""), (3, b"")]
    assert sd.remove_repeats(frame(spark, []), 16).collect() == []


def test_kept_text_leaves_out_broken_characters(spark):
    rows = [(1, "é" * 8 + "x"), (2, "y" + "é" * 8), (3, "é"), (4, None)]  # odd cuts split characters
    got = {r.doc_id: (bytes(r.kept_bytes), r.kept_text) for r in sd.remove_repeats(frame(spark, rows), 15).collect()}
    assert got == {1: (b"x", "x"), 2: (b"y", "y"), 3: ("é".encode(), None), 4: (b"", None)}
    cut = [(1, "a" + "\u0101" * 9), (2, "\u0101" * 8 + "b")]
    for r in sd.remove_repeats(frame(spark, cut), 15).collect():
        assert r.kept_text == bytes(r.kept_bytes).decode("utf-8", "ignore")


def test_hot_piece_and_equal_rows_stay_linear(spark, monkeypatch):
    """5,000 rows of one text, and one passage in 300 texts: a row per
    distinct piece, and at most one per piece and text."""
    made = {}
    put = sd.Stages.put

    def spy(self, df, name):
        made[name] = put(self, df, name)
        return made[name]

    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    same, passage = word(900), word(120)
    rows = [(7, same)] * 5000 + [(100 + i, word(150) + passage + word(150)) for i in range(300)]
    monkeypatch.setattr(sd.Stages, "put", spy)
    counted = {}
    drop = sd.Stages.drop

    def note(self, *names):
        counted.update({n: made[n].count() for n in names if n in made})
        drop(self, *names)

    monkeypatch.setattr(sd.Stages, "drop", note)
    got = sd.remove_repeats(frame(spark, rows), 100).collect()
    assert {(r.n_bytes, r.n_removed) for r in got if r.doc_id == 7} == {(900, 900)}
    check([r for r in got if r.doc_id != 7], rows[5000:], 100)
    assert counted["todo"] <= 301 and counted["pieces"] <= 3000 and counted["hits"] <= counted["once"] <= counted["pieces"]


@pytest.mark.parametrize("large", [150, 2000])
def test_large_buckets_are_cut_into_sub_buckets(spark, monkeypatch, large):
    """Many different pieces around one gram: sorted in sub-buckets, down to
    single windows."""
    monkeypatch.setattr(sd, "LARGE_BYTES", large)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(60)
    rows = [(i, word(rng.randint(0, 40)) + passage[rng.randint(0, 9):] + word(rng.randint(0, 40))) for i in range(120)]
    rows += [(500 + i, "ab" * (40 + i)) for i in range(20)]  # one gram at many places
    check(sd.remove_repeats(frame(spark, rows), 50).collect(), rows, 50)
