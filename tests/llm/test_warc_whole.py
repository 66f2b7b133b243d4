"""Headers of any length, and records beside damage inside a gzip member."""

import gzip
import random

from folio.llm import warc
from tests.llm.helpers import frame
from tests.llm.test_warc import SCHEMA, gaps, ids, record


def test_a_page_with_a_url_of_200_kb_comes_back(spark):
    url = "data:text/plain," + "x" * 200_000
    rows = [(1, "http://a", "one"), (2, url, "two"), (3, "http://c", "three")]
    got = warc.round_trip(frame(spark, rows, SCHEMA)).collect()
    assert sorted((r.kind, r.record_id, r.target_uri) for r in got) == sorted(("record", f"<urn:page:{p}>", u) for p, u, _ in rows)


def test_a_long_header_without_end_costs_one_record():
    a, b, c = record("a", b"A"), record("b", b"B", **{"WARC-Target-URI": "u" * 200_000}), record("c", b"C")
    assert ids(a + b + c) == ["a", "b", "c"]
    cut = b[:150_000]
    assert ids(a + cut + c) == ["a", "c"] and gaps(a + cut + c)[0][:2] == (len(a), len(a + cut))
    assert gaps(a + cut) == [(len(a), len(a + cut), "header without end")]


def test_records_beside_damage_in_one_gzip_member():
    rng = random.Random(3)
    parts = [record(n, bytes(rng.randrange(256) for _ in range(20_000))) for n in "abcd"]
    bad = parts[1].replace(b"WARC-Type: ", b"WARC-Type ", 1)
    whole = gzip.compress(parts[0] + bad + parts[2])
    assert ids(whole) == ["a", "c"] and gaps(whole) == [(0, len(whole), "bad header line")]
    stream = gzip.compress(b"".join(parts))
    after = gzip.compress(record("z", b"Z"))
    cut = stream[:len(stream) * 5 // 8]
    assert ids(cut) == ["a", "b"] and gaps(cut) == [(0, len(cut), "truncated gzip member")]
    assert ids(cut + after)[:2] == ["a", "b"] and ids(cut + after)[-1] == "z"
    assert gaps(cut + after)[0][0] == 0
    broken = bytearray(stream)
    broken[-6] ^= 0x55  # the check sum of the member: all records have passed their own
    assert ids(bytes(broken) + after) == [*"abcd", "z"] and gaps(bytes(broken) + after)[0][2] == "damaged gzip member"
