import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import wordhash as wh
from folio.llm.common import grouped_stream, row_chunks, text_bytes
from tests.llm.helpers import WORD


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c", max_size=30)), min_size=1, max_size=8))
def test_words_match_the_pattern_and_equal_words_have_equal_hashes(texts):
    data, offs = text_bytes(pa.array(texts, pa.string()))
    starts, ends, rows = wh.words(data, offs)
    got = [[data[a:b].tobytes().decode() for a, b in zip(starts[rows[i]:rows[i + 1]], ends[rows[i]:rows[i + 1]])] for i in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]
    h = wh.word_hashes(data, starts, ends)
    flat = [w for row in got for w in row]
    assert len(set(h.tolist())) == len(set(flat)) == len(set(zip(flat, h.tolist())))


def test_word_hash_does_not_depend_on_the_place():
    a = np.frombuffer(b"xx yy zz", np.uint8)
    b = np.frombuffer(b"zz xx", np.uint8)
    ha = wh.word_hashes(a, *wh.words(a, np.array([0, 8]))[:2])
    hb = wh.word_hashes(b, *wh.words(b, np.array([0, 5]))[:2])
    assert ha[0] == hb[1] and ha[2] == hb[0]
    assert wh.window_hashes(ha, 2)[0] != wh.window_hashes(ha[::-1].copy(), 2)[-1]
    assert len(wh.window_hashes(ha, 4)) == 0


def test_row_chunks_cover_all_rows_in_order():
    offs = np.cumsum([0, 5, 0, 50, 1, 1, 200, 3])
    got = list(row_chunks(offs, 20))
    assert got[0][0] == 0 and got[-1][1] == 7 and all(a[1] == b[0] for a, b in zip(got, got[1:]))


def test_grouped_stream_joins_groups_across_batches():
    def batch(k, v):
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(v)], names=["k", "v"])

    got = [(g["k"][0], g["v"]) for g in grouped_stream([batch([1, 1], [1, 2]), batch([1, 2], [3, 4]), batch([2], [5])], ["k"])]
    assert got == [(1, [1, 2, 3]), (2, [4, 5])]
