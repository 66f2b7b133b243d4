import gzip
import hashlib
import os
import random

from folio.llm import warc
from tests.llm.helpers import frame

SCHEMA = "page_id long, url string, html string"


def record(name: str, payload: bytes, **over) -> bytes:
    block = warc.HTTP.encode() + payload
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{name}>", "Content-Type": "application/http;msgtype=response",
              "WARC-Block-Digest": "sha1:" + hashlib.sha1(block).hexdigest(), "Content-Length": str(len(block))} | over
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def names(data: bytes):
    return [r[3]["warc-record-id"] if r[0] == "record" else (r[1], r[2], r[3]) for r in warc.salvage(data)]


def ids(data: bytes):
    return [n[len("<urn:page:"):-1] for n in names(data) if isinstance(n, str)]


def gaps(data: bytes):
    return [n for n in names(data) if not isinstance(n, str)]


def test_records_with_every_payload_come_back():
    parts = [b"", b"\r\n\r\nWARC/1.1\r\n\r\n", b"\x1f\x8b\x08 not gzip", "é".encode() * 5000]
    data = b"".join(record(str(i), p) for i, p in enumerate(parts))
    got = list(warc.salvage(data))
    assert [r[0] for r in got] == ["record"] * 4 and [r[4][len(warc.HTTP):] for r in got] == parts


def test_damage_costs_only_the_damaged_record():
    a, b, c = record("a", b"A" * 300), record("b", b"B" * 300), record("c", b"C" * 300)
    damaged = {
        "no version line": b"XARC" + b[4:],
        "bad content length": b.replace(b"Content-Length: ", b"Content-Length: x"),
        "no end mark": b[:200] + b[210:],  # bytes lost
        "block digest differs": b.replace(b"BBBB", b"BXBB", 1),
        "bad header line": b.replace(b"WARC-Type: ", b"WARC-Type ", 1),
    }
    for why, bad in damaged.items():
        data = a + bad + c
        assert ids(data) == ["a", "c"], why
        (start, stop, reason), = gaps(data)
        assert (start, stop, reason) == (len(a), len(a + bad), why)
    assert gaps(a + b[:150]) == [(len(a), len(a) + 150, "header without end")] or gaps(a + b[:150])[0][2] == "truncated block"
    assert gaps(a + b[:-200])[0][2] == "truncated block" and ids(a + b[:-200]) == ["a"]
    assert gaps(b"junk" + a) == [(0, 4, "no version line")] and ids(b"junk" + a) == ["a"]
    assert list(warc.salvage(b"")) == []


def test_gzip_members_are_salvaged():
    z = [gzip.compress(record(n, n.encode() * 500)) for n in "abcd"]
    assert ids(b"".join(z)) == list("abcd") and gaps(b"".join(z)) == []
    broken = bytearray(z[1])
    broken[len(broken) // 2] ^= 0x55
    data = z[0] + bytes(broken) + z[2] + z[3]
    assert ids(data) == ["a", "c", "d"] and gaps(data)[0][:2] == (len(z[0]), len(z[0]) + len(broken))
    assert ids(z[0] + z[1][:20]) == ["a"]
    assert ids(z[0] + record("p", b"plain") + z[2]) == ["a", "p", "c"]


def test_random_damage_never_loses_the_other_records():
    rng = random.Random(7)
    parts = [record(str(i), bytes(rng.randrange(256) for _ in range(rng.randrange(400)))) for i in range(8)]
    for _ in range(60):
        hit = rng.randrange(8)
        bad = bytearray(parts[hit])
        bad[rng.randrange(len(bad))] ^= rng.randrange(1, 256)
        data = b"".join(parts[:hit]) + bytes(bad) + b"".join(parts[hit + 1:])
        assert set(ids(data)) >= {str(i) for i in range(8) if i != hit}


def rows():
    big = "x" * 999 + "é"
    return [(1, "http://a", big), (2, "http://b\r\nInjected: 1", big), (3, None, big), (4, "http://d", "x" * 999), (5, "http://e", "x" * 999),
            (6, "http://f", None), (7, "http://g", ""), (8, "http://h", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 80), (9, "http://i", big + "y")]


def digest(got):
    return sorted((r.record_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in got if r.kind == "record")


def test_round_trip_through_spark(spark):
    got = warc.round_trip(frame(spark, rows(), SCHEMA)).collect()
    assert all(r.kind == "record" for r in got) and len(got) == 9
    by = {r.record_id: r for r in got}
    for page, _, html in rows():
        raw = (html or "").encode()
        r = by[f"<urn:page:{page}>"]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        first = "<urn:page:3>" if page in (1, 2) else None
        assert (r.record_type, r.refers_to) == ("revisit" if first else "response", first)
        assert first or bytes(r.payload) == raw
    assert by["<urn:page:2>"].target_uri == "http://b Injected: 1"


def test_null_and_repeated_ids_extra_columns_and_empty_table(spark):
    big = "q" * 2000
    data = [(None, "u", big, 1), (7, "u", big, 2), (7, "u", big, 3), (6, "u", big, 4), (None, "u", "z" * 1500, 5)]
    got = warc.round_trip(spark.createDataFrame(data, SCHEMA + ", digest int")).collect()
    assert sorted((r.record_id, r.record_type) for r in got) == [
        ("<urn:page:6>", "revisit"), ("<urn:page:7>", "response"), ("<urn:page:7>", "response"), ("<urn:page:>", "response"), ("<urn:page:>", "revisit")]
    assert warc.round_trip(frame(spark, [], SCHEMA)).collect() == []


def test_damaged_files_are_read_by_spark(spark, tmp_path):
    a, b, c = (record(n, n.encode() * 100) for n in "abc")
    (tmp_path / "one.warc").write_bytes(a + b[:-30] + c)
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(a) + gzip.compress(b))
    (tmp_path / "none.warc").write_bytes(b"")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted((os.path.basename(r.archive), r.record_id) for r in got if r.kind == "record") == [
        ("one.warc", "<urn:page:a>"), ("one.warc", "<urn:page:c>"), ("two.warc.gz", "<urn:page:a>"), ("two.warc.gz", "<urn:page:b>")]
    (gap,) = [r for r in got if r.kind == "gap"]
    assert (gap.start, gap.stop) == (len(a), len(a) + len(b) - 30) and gap.reason
