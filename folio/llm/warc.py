"""WARC archives: a writer through Spark's text sink and a salvage reader.

Writing.  Every page is one record.  Among records with equal payloads of at
least ``least`` bytes the one with the largest page_id is the response and
the others are revisits of it; the pairs are found on digests, and only
duplicated digests are joined back.  A record ends in two line breaks, which
is the line separator of the text sink, so the archives are written and
committed by Spark on any file system it knows.

Reading.  Archives (plain records or gzip members of any number of records)
are read as binary files and parsed inside tasks.  Version line, header, length, end mark
and block digest of every record are checked.  After a failed check the
reader looks for the next member or version line that passes all checks,
goes on from there, and reports the bytes between as a gap with the reason.
Archives must be of moderate size (one is held by a task at a time); the
writer's files hold ``FILE_RECORDS`` records.

Defined results: a null html is an empty payload; pages without page_id are
written and come back without one, and are a response unless a page with an
id has the same payload; repeated rows with one page_id are all responses if
that id is the largest; line breaks in urls become spaces; headers (urls) have any
length; other columns are ignored; an empty table writes and returns nothing; an empty file has neither
records nor gaps.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import Stages, map_text
from folio.session import scratch_path

LEAST = 1000
FILE_RECORDS = 2000
STEP = 1 << 12
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

SCHEMA = ("archive string, start long, stop long, kind string, reason string, record_type string, record_id string, "
          "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary")


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id and the record text (without its end mark) of every page."""
    st = Stages(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    same = st.put(rows.filter(F.col("size") >= least).groupBy("digest", "size")
                  .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n"), "same")
    rows = rows.join(same, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("html")))
    url = F.coalesce(F.regexp_replace("url", "[\\r\\n]+", " "), F.lit(""))
    rows = rows.select("page_id", "digest", "size", "first", revisit.alias("revisit"), name.alias("name"), url.alias("url"), block.alias("block"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), F.col("name"), F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nWARC-Block-Digest: sha1:"), F.sha1(F.col("block").cast("binary")),
        F.when(F.col("revisit"), F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
            F.col("first").cast("string"), F.lit(">\r\nX-Payload-Length: "), F.col("size").cast("string"))).otherwise(""),
        F.lit("\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit(END))
    return rows.select("page_id", F.concat(header, F.col("block")).alias("record"))


def write_archives(recs: DataFrame, path: str, per_file: int = FILE_RECORDS) -> None:
    """Plain archives of at most ``per_file`` records under ``path``."""
    recs.select(F.col("record").alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


def _digest_ok(said: str, data: bytes) -> bool:
    if not said.lower().startswith("sha1:"):
        return True  # unknown algorithms can't be checked
    value, own = said[5:], hashlib.sha1(data).digest()
    return value.lower() == own.hex() or value.upper() == base64.b32encode(own).decode()


def _plain(data: bytes, at: int) -> tuple[int, dict[str, str], bytes] | str:
    """Record at ``at``: its end, headers and block, or why it fails."""
    if data[at:at + 7] != b"WARC/1." or data[at + 8:at + 10] != b"\r\n":
        return "no version line"
    fields: dict[str, str] = {}
    # Lines are read up to the empty one; a version line of a later record has
    # no colon, so a damaged header ends there.
    begin = at + 10
    while (stop := data.find(b"\r\n", begin)) != begin:
        if stop < 0:
            return "header without end"
        name, colon, value = data[begin:stop].partition(b":")
        if not colon:
            return "bad header line"
        name = name.strip().lower().decode("utf-8", "replace")
        if name in fields and name in ("warc-type", "warc-record-id", "content-length"):
            return "repeated header field"  # a cut header ran on into the next one
        fields[name] = value.strip().decode("utf-8", "replace")
        begin = stop + 2
    begin += 2
    size = fields.get("content-length", "")
    if not size.isdigit():
        return "bad content length"
    if "warc-type" not in fields or "warc-record-id" not in fields:
        return "mandatory field missing"
    end = begin + int(size)
    if end > len(data):
        return "truncated block"
    if data[end:end + 4] != b"\r\n\r\n":
        return "no end mark"
    block = data[begin:end]
    if not _digest_ok(fields.get("warc-block-digest", ""), block):
        return "block digest differs"
    return end + 4, fields, block


def _member(data: bytes, at: int) -> tuple[int, bytes, str]:
    """Gzip member at ``at``: its end (0 if that is not known), the bytes
    decompressed up to there or to the damage, and why they end."""
    unzip = zlib.decompressobj(31)
    parts, pos, why = [], at, ""
    try:
        while not unzip.eof and pos < len(data):
            # Small steps: what a step that fails has decompressed is lost.
            parts.append(unzip.decompress(data[pos:pos + STEP]))
            pos += STEP
    except zlib.error:
        # Again byte by byte, up to the one that fails.
        unzip = zlib.decompressobj(31)
        parts, why = [], "damaged gzip member"
        try:
            parts.append(unzip.decompress(data[at:pos]))
            for i in range(pos, min(pos + STEP, len(data))):
                parts.append(unzip.decompress(data[i:i + 1]))
        except zlib.error:
            pass
    plain = b"".join(parts)
    if not why and unzip.eof:
        return min(pos, len(data)) - len(unzip.unused_data), plain, "" if plain else "empty gzip member"
    return 0, plain, why or "truncated gzip member"


def _plain_parts(data: bytes, why: str = "") -> Iterator[tuple]:
    """Records and gaps of plain bytes; ``why`` the bytes end, if not whole."""
    at, gap, reason = 0, -1, ""
    while at < len(data):
        got = _plain(data, at)
        if not isinstance(got, str):
            if gap >= 0:
                yield "gap", gap, at, reason, None
                gap = -1
            yield "record", at, got[0], got[1], got[2]
            at = got[0]
            continue
        if gap < 0:
            gap, reason = at, why if why and got.startswith(("truncated", "header without")) else got
        at = data.find(b"WARC/1.", at + 1)
        if at < 0:
            at = len(data)
    if gap >= 0:
        yield "gap", gap, len(data), reason, None


def salvage(data: bytes) -> Iterator[tuple]:
    """('record', start, stop, headers, block) for every record that passes
    the checks and ('gap', start, stop, reason, None) for the bytes between.

    A gzip member gives its records, also if it is damaged or cut after them;
    they and the gaps between them have the compressed bytes of the member.  A
    member without an end reaches to the next member or version line."""
    at, gap, why = 0, -1, ""
    while at < len(data):
        inner: list[tuple] = []
        if data[at:at + 2] == b"\x1f\x8b":
            end, plain, got = _member(data, at)
            inner = list(_plain_parts(plain, got))
            found = any(x[0] == "record" for x in inner)
            if not found and inner and not got:
                got = inner[0][3]
        else:
            one = _plain(data, at)
            found = not isinstance(one, str)
            end, got = (one[0], "") if found else (0, one)
            inner = [("record", at, end, one[1], one[2])] if found else []
        if found:
            if gap >= 0:
                yield "gap", gap, at, why, None
                gap = -1
            stop = end or _next(data, at)
            for kind, _, _, info, block in inner:
                yield kind, at, stop, info, block
            if not end and inner[-1][0] == "record":
                yield "gap", at, stop, got, None
            at = stop
            continue
        if gap < 0:
            gap, why = at, got
        at = _next(data, at)
    if gap >= 0:
        yield "gap", gap, len(data), why, None


def _next(data: bytes, at: int) -> int:
    """Where the next version line or gzip member may be."""
    nexts = [p for p in (data.find(b"WARC/1.", at + 1), data.find(b"\x1f\x8b\x08", at + 1)) if p > 0]
    return min(nexts, default=len(data))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps of the archives under ``path`` (see SCHEMA).
    Payload digest and length of a response are computed from what was read;
    those of a revisit are its header's."""

    def fn(batch: pa.RecordBatch):
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = []
            for kind, start, stop, info, block in salvage(content.as_py() or b""):
                if kind == "gap":
                    rows.append((name, start, stop, kind, info, *[None] * 7))
                    continue
                payload = block
                if info.get("content-type", "").startswith("application/http"):
                    payload = block[block.find(b"\r\n\r\n") + 4:]
                if info.get("warc-type") == "revisit":
                    digest, size = info.get("warc-payload-digest", "")[5:], info.get("x-payload-length", "")
                    size = int(size) if size.isdigit() else None
                    payload = None
                else:
                    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                rows.append((name, start, stop, kind, None, info.get("warc-type"), info.get("warc-record-id"), info.get("warc-target-uri"),
                             info.get("warc-refers-to"), digest, size, payload))
                if len(rows) >= 500:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return map_text(spark.read.format("binaryFile").load(path).select("path", "content"), fn, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc-archives")
    write_archives(records(pages, least), path)
    return read_archives(pages.sparkSession, path)
