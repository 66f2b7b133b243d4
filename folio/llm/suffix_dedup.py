"""Exact repeated-substring removal by blockwise suffix sorting with a
difference cover.

A byte is removed if a ``length``-byte string covering it also starts at any
other position, in the same or another text; matches never cross texts.

Method
  1. Buckets.  Every window of ``length`` bytes is put in the bucket of the
     smallest hash among its short grams.  Equal windows have equal buckets,
     and consecutive windows mostly share one, so a text is a list of runs
     (bucket, first window, last window).  A bucket of one place holds no
     repeat; its windows need no sorting.  Buckets are pre-aggregated.
  2. Equal texts (by a 128-bit hash) stand for each other: one of them takes
     part, and a text that is there twice is a repeat as a whole.
  3. The bytes under each remaining run are dealt out by bucket.  Equal
     pieces of one bucket collapse to one row first.
  4. One block at a time (whole buckets, ``BLOCK_BYTES`` or one bucket of up
     to ``LARGE_BYTES``) the suffixes at
     window starts are sorted to depth ``length``: by their first V bytes,
     then, in every tie, against a pivot.  Two suffixes i and j are compared
     through a shift d < V at which both i + d and j + d lie in a difference
     cover modulo V; ranks of the cover sample, computed beforehand by
     prefix doubling, decide that comparison in constant time however long
     the tie is.  Suffixes equal to depth ``length`` are repeats.
  5. A bucket beyond ``LARGE_BYTES`` is cut into sub-buckets, which are
     sorted in the same way: by how far into the window the bucket's gram
     starts (a range of ``STEPS`` places) and by the bytes that all windows
     of that range share.  Equal windows agree in both.  Sub-buckets that
     are still too large are cut again by narrower ranges, down to single
     windows, of which equal ones collapse.
  6. The repeats of a distinct piece are one row of merged ranges.  They are
     carried back to the texts, one row per piece, and cut out there.

Defined results: a null text is empty; texts shorter than ``length`` keep all
bytes.  Rows that repeat a text, with or without its doc_id, are separate
texts, so each removes what the other repeats.  doc_id is not looked at, so
it may be missing.  An empty table gives none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folio.llm import wordhash as wh
from folio.llm.common import Stages, broadcast_if_small, map_text, release_memory, row_chunks, text_bytes

LENGTH = 400
#: Bytes of a passage of some 50 words.  On documents that share 51 words
#: with another one, 280-byte repeats find 99 of 100, 400-byte repeats 76.
PASSAGE = 280
BLOCK_BYTES = 500_000
LARGE_BYTES = 1_500_000
PIECE_BYTES = 1 << 20
PERIOD = 32
#: Window starts of a sub-bucket, from the first cut of a large bucket on.
STEPS = (48, 7, 1)
BROADCAST_BUCKETS = 500_000
#: Rows and array entries (24 bytes at most each) of a side that is broadcast
#: to the texts; a larger side is joined by a shuffle of the texts.
BROADCAST_ENTRIES = 2_000_000


def gram_length(length: int) -> int:
    return max(1, min(64, length // 4))


def difference_cover(period: int) -> np.ndarray:
    """Residues whose pairwise differences cover all residues: the first
    sqrt(period) numbers and the multiples of that root."""
    step = int(np.ceil(np.sqrt(period)))
    return np.unique([i % period for i in [*range(step), *range(0, period + step, step)]])


def cover_shifts(period: int) -> np.ndarray:
    """For residues a and b the least d with a + d and b + d in the cover."""
    inside = np.isin(np.arange(period), difference_cover(period))
    r = np.arange(period)
    both = inside[(r[:, None, None] + r) % period] & inside[(r[None, :, None] + r) % period]
    return both.argmax(axis=2)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    s = wh.prefix_sums(data)
    n = len(data) - gram + 1
    _, down = wh.powers(max(1, n))
    return wh.finalise((s[gram:] - s[:n]) * down[:n])


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (block prefix and suffix
    minima)."""
    n = len(h) - width + 1
    pad = -len(h) % width
    blocks = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def window_runs(data: np.ndarray, row_ends: np.ndarray, length: int):
    """Runs of windows with one bucket: bucket, first and last window, and
    whether the run may hold two equal windows.  ``row_ends`` are the ends of
    the texts that ``data`` concatenates."""
    gram = gram_length(length)
    width = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none.astype(bool)
    h = gram_hashes(data, gram)
    low = sliding_min(h, width)
    ok = np.zeros(len(data) + 1, np.int32)
    starts = np.concatenate([[0], row_ends[:-1]])
    fits = row_ends - starts >= length
    np.add.at(ok, starts[fits], 1)
    np.add.at(ok, row_ends[fits] - length + 1, -1)
    inside = np.cumsum(ok)[:len(low)] > 0
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | ~inside[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    new |= edge[:len(low)]
    first = np.flatnonzero(inside & new)
    if not len(first):
        return none.astype(np.uint64), none, none, none.astype(bool)
    stop = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~new[1:], [False]]))
    anchor = np.empty(len(first), np.int64)
    for i in range(0, len(first), 2048):
        at = first[i:i + 2048]
        anchor[i:i + 2048] = at + h[at[:, None] + np.arange(width)[None, :]].argmin(axis=1)
    return low[first], first, stop, stop > anchor


KEYS = ["k1", "k2"]


def merged(spans: list[dict] | None) -> list[dict]:
    """Sorted byte ranges, those that touch made one."""
    out: list[dict] = []
    for s in spans or []:
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append({"start": s["start"], "end": s["end"]})
    return out


def _text_keys(text) -> list[F.Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def bucket_runs(docs: DataFrame, length: int) -> DataFrame:
    """One row per run of ``docs`` (k1, k2, doc_id, text): bucket, keys of
    the text, doc_id, first and last window, weight (2 if the run may repeat
    itself).  If there is a column ``spans``, only windows inside one of its
    byte ranges count."""
    limited = "spans" in docs.columns

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("text"))
        owner, start = np.arange(len(offs) - 1), np.zeros(len(offs) - 1, np.int64)
        if limited:
            parts = [(i, s["start"], s["end"]) for i, spans in enumerate(batch.column("spans").to_pylist()) for s in merged(spans) if s["end"] - s["start"] >= length]
            if not parts:
                return
            owner, start, end = (np.array(c, np.int64) for c in zip(*parts))
            data = np.concatenate([data[offs[i] + a:offs[i] + b] for i, a, b in parts])
            offs = np.concatenate([[0], np.cumsum(end - start)])
        rows, cols = [], []
        for lo, hi in row_chunks(offs):
            a, b = offs[lo], offs[hi]
            if hi - lo == 1 and b - a > PIECE_BYTES:
                spans = [(p, min(b, p + PIECE_BYTES + length - 1)) for p in range(a, b - length + 1, PIECE_BYTES)]
                parts = [(p, np.array([q - p])) for p, q in spans]
            else:
                parts = [(a, offs[lo + 1:hi + 1] - a)]
            for base, ends in parts:
                bucket, first, last, twice = window_runs(data[base:base + ends[-1]], ends, length)
                row = np.searchsorted(offs[lo:hi + 1], base + first, side="right") - 1 + lo
                rows.append(owner[row])
                moved = base - offs[row] + start[row]
                cols.append((bucket.view(np.int64), first + moved, last + moved, 1 + twice))
        row = pa.array(np.concatenate(rows))
        bucket, first, last, weight = (np.concatenate([c[i] for c in cols]) for i in range(4))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), *(batch.column(k).take(row) for k in [*KEYS, "doc_id"]),
             pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(weight, pa.int32())],
            names=["bucket", *KEYS, "doc_id", "first", "last", "weight"])

    return map_text(docs.select(*KEYS, "doc_id", "text", *(["spans"] if limited else [])), fn, "bucket long, k1 long, k2 long, doc_id long, first int, last int, weight int")


def digests(parts: list[bytes]) -> list[pa.Array]:
    """128-bit digests, as two columns."""
    d = np.frombuffer(b"".join(hashlib.blake2b(p, digest_size=16).digest() for p in parts), np.int64).reshape(-1, 2)
    return [pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())]


#: A piece, and where it is: in the text (or larger piece) k1, k2 from first.
PIECES = "bucket long, p1 long, p2 long, k1 long, k2 long, first int, piece binary"


def _pieces(docs: DataFrame, length: int) -> DataFrame:
    """The bytes under every run, with a 128-bit digest of them."""

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("text"))
        raw = data.tobytes()
        runs = batch.column("runs")
        at = np.asarray(runs.offsets) if not isinstance(runs, pa.ChunkedArray) else np.asarray(runs.combine_chunks().offsets)
        flat = runs.values
        bucket, first, last = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("bucket", "first", "last"))
        row, piece = [], []
        out = 0

        def send(lo: int, hi: int):
            take = pa.array(row, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[lo:hi]), *digests(piece), *(batch.column(k).take(take) for k in KEYS),
                 pa.array(first[lo:hi]), pa.array(piece, pa.binary())],
                names=["bucket", "p1", "p2", *KEYS, "first", "piece"])

        lo = at[0]
        for i in range(batch.num_rows):
            base = int(offs[i])
            for k in range(at[i], at[i + 1]):
                piece.append(raw[base + int(first[k]):base + int(last[k]) + length])
                row.append(i)
                out += len(piece[-1])
                if out > PIECE_BYTES:
                    yield send(lo, k + 1)
                    lo, out, row, piece = k + 1, 0, [], []
        if row:
            yield send(lo, at[batch.num_rows])

    return map_text(docs, fn, PIECES)


def repeated_windows(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at ``starts`` occur at two or more of them.

    Blockwise suffix sorting to depth ``length``; see the module text.
    """
    period = 1 << int(np.log2(max(1, min(PERIOD, length // 8))))
    depth = period
    while depth * 2 <= length - period:
        depth *= 2
    n = len(text)
    pad = np.concatenate([text, np.zeros(2 * length + 64, np.uint8)])
    rank = pad[:n + length].astype(np.int64)
    size = 1
    while size < period:  # rank of the first `period` bytes everywhere
        nxt = np.zeros_like(rank)
        nxt[:-size] = rank[size:]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + nxt, return_inverse=True)
        size *= 2
    prefix = rank
    cover = difference_cover(period)
    in_cover = np.zeros(period, bool)
    in_cover[cover] = True
    sample = np.flatnonzero(in_cover[np.arange(len(prefix)) % period])
    order = np.zeros(len(prefix) + period, np.int64)
    order[sample] = np.arange(len(sample))
    srank = prefix[sample]
    while size < depth:  # p + size lies in the sample if p does
        ahead = sample + size
        there = ahead < len(prefix)
        nxt = np.zeros_like(srank)
        nxt[there] = srank[order[ahead[there]]] + 1
        _, srank = np.unique(srank * (int(nxt.max()) + 2) + nxt, return_inverse=True)
        size *= 2
    shift = cover_shifts(period)

    def compare(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        d = shift[i % period, j % period]
        far = d + (length - depth - d) // period * period
        out = np.sign(srank[order[i + d]] - srank[order[j + d]])
        out = np.where(out == 0, np.sign(srank[order[i + far]] - srank[order[j + far]]), out)
        return np.where(out == 0, np.sign(prefix[i + length - period] - prefix[j + length - period]), out)

    repeated = np.zeros(len(starts), bool)
    idx = np.argsort(prefix[starts], kind="stable")
    key = prefix[starts[idx]]
    while len(idx):
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(new) - 1
        count = np.bincount(group)
        many = count[group] > 1
        idx, group, count = idx[many], group[many], count
        if not len(idx):
            break
        new = np.concatenate([[True], group[1:] != group[:-1]])
        head = np.flatnonzero(new)
        sizes = np.diff(np.concatenate([head, [len(idx)]]))
        pivot = idx[head + sizes // 2].repeat(sizes)
        c = compare(starts[idx], starts[pivot])
        same = c == 0
        group = np.arange(len(head)).repeat(sizes)
        equal = np.bincount(group, weights=same) > 1
        repeated[idx[same & equal[group]]] = True
        idx, group, c = idx[~same], group[~same], c[~same]
        key = group * 2 + (c > 0)
        by = np.argsort(key, kind="stable")
        idx, key = idx[by], key[by]
    return repeated


def _block(rows: list[tuple], length: int) -> pa.RecordBatch | None:
    """Repeated windows of the pieces of whole buckets."""
    text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    ends = np.cumsum([len(r[4]) for r in rows])
    begin = ends - np.array([len(r[4]) for r in rows])
    n_win = ends - begin - length + 1
    owner = np.arange(len(rows)).repeat(n_win)
    local = np.arange(len(owner)) - (np.cumsum(n_win) - n_win)[owner]
    dup = repeated_windows(text, begin[owner] + local, length)
    dup |= np.array([r[3] for r in rows])[owner]
    if not dup.any():
        return None
    o, w = owner[dup], local[dup]
    # Windows that touch are one range of bytes.
    head = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (w[1:] > w[:-1] + length)]))
    tail = np.append(head[1:], len(o)) - 1
    who, at = np.unique(o[head], return_index=True)
    ranges = pa.StructArray.from_arrays([pa.array(w[head], pa.int32()), pa.array(w[tail] + length, pa.int32())], names=["start", "end"])
    return pa.RecordBatch.from_arrays(
        [*(pa.array([rows[i][c] for i in who], pa.int64()) for c in range(3)),
         pa.ListArray.from_arrays(pa.array(np.append(at, len(head)), pa.int32()), ranges)],
        names=["bucket", "p1", "p2", "ranges"])


HITS = "bucket long, p1 long, p2 long, ranges array<struct<start:int,end:int>>"


def _sort_blocks(pieces: DataFrame, length: int) -> DataFrame:
    def run(batches):
        held, size = [], 0
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("bucket", "p1", "p2", "twice", "piece")]
            for row in zip(*cols):
                if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                    out = _block(held, length)
                    if out is not None:
                        yield out
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            out = _block(held, length)
            if out is not None:
                yield out
        release_memory()

    return (pieces.repartition("bucket").sortWithinPartitions("bucket")
            .select("bucket", "p1", "p2", "twice", "piece")
            .mapInArrow(run, HITS))


def sub_runs(piece: bytes, bucket: int, length: int, step: int) -> list[tuple[int, int, int]]:
    """Runs of the windows of a piece that belong to one sub-bucket: its key,
    first and last window."""
    data = np.frombuffer(piece, np.uint8)
    here = np.flatnonzero(gram_hashes(data, gram_length(length)).view(np.int64) == bucket)
    w = np.arange(len(data) - length + 1)
    anchor = here[np.searchsorted(here, w)]
    part = (anchor - w) // step
    head = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (anchor[1:] != anchor[:-1])]))
    tail = np.append(head[1:], len(w)) - 1
    out = []
    for a, b in zip(head.tolist(), tail.tolist()):
        low = int(anchor[a] - part[a] * step)  # what all windows of the range share
        core = piece[low:low - step + 1 + length]
        name = hashlib.blake2b(core + int(part[a]).to_bytes(4, "little") + int(bucket).to_bytes(8, "little", signed=True), digest_size=8)
        out.append((int.from_bytes(name.digest(), "little", signed=True), a, b))
    return out


def _sub_pieces(pieces: DataFrame, length: int, step: int) -> DataFrame:
    """Pieces of sub-buckets; (k1, k2) is the digest of the larger piece and
    ``top`` the bucket whose gram it was dealt by."""

    def fn(batch: pa.RecordBatch):
        for top, gram, p1, p2, piece in zip(*(batch.column(n).to_pylist() for n in ("bucket", "gram", "p1", "p2", "piece"))):
            runs = sub_runs(piece, gram, length, step)
            some = max(1, PIECE_BYTES // (length + step))
            for lo in range(0, len(runs), some):
                part = runs[lo:lo + some]
                cut = [piece[a:b + length] for _, a, b in part]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in part]), *digests(cut), pa.array([p1] * n), pa.array([p2] * n), pa.array([r[1] for r in part], pa.int32()),
                     pa.array(cut, pa.binary()), pa.array([top] * n), pa.array([gram] * n)],
                    names=["bucket", "p1", "p2", *KEYS, "first", "piece", "top", "gram"])

    return map_text(pieces.select("bucket", "gram", "p1", "p2", "piece"), fn, PIECES + ", top long, gram long")


def _once(found: DataFrame) -> DataFrame:
    """Distinct pieces of every bucket; ``twice``: it is at two places."""
    two = (F.min("k1") < F.max("k1")) | (F.min("k2") < F.max("k2")) | (F.min("first") < F.max("first"))
    return found.groupBy("bucket", "p1", "p2").agg(two.alias("twice"), F.first("piece").alias("piece"), F.min("gram").alias("gram"))


def _shifted(found: DataFrame, hits: DataFrame, *keys: str) -> DataFrame:
    """``ranges`` of the larger whole (``keys``) from those of its pieces: one
    row per piece, then one per whole."""
    moved = F.transform("ranges", lambda r: F.struct((r["start"] + F.col("first")).alias("start"), (r["end"] + F.col("first")).alias("end")))
    rows = found.join(hits, ["bucket", "p1", "p2"]).select(*keys, moved.alias("ranges"))
    return rows.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_set("ranges"))).alias("ranges"))


def _hits(once: DataFrame, length: int, st: Stages, level: int = 0) -> DataFrame:
    """``ranges`` of the repeats in every distinct piece that has any."""
    if level == len(STEPS):
        return _sort_blocks(once, length)
    large = st.put(once.groupBy("bucket").agg(F.sum(F.octet_length("piece")).alias("size")).filter(F.col("size") > LARGE_BYTES).drop("size"), f"large{level}")
    n_large = large.count()
    if not n_large:
        return _sort_blocks(once, length)
    few = broadcast_if_small(large, n_large, BROADCAST_BUCKETS)
    hits = _sort_blocks(once.join(few, "bucket", "left_anti"), length)
    parts = once.join(few, "bucket", "left_semi")
    found = st.put(_sub_pieces(parts, length, min(STEPS[level], max(1, length // 2))), f"found{level}")
    sub = st.put(_once(found), f"once{level}")
    inner = st.put(_hits(sub, length, st, level + 1), f"hits{level}")
    back = _shifted(found.drop("piece", "gram"), inner, "top", *KEYS).select(F.col("top").alias("bucket"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), "ranges")
    # A piece at two places is a repeat as a whole.
    whole = F.array(F.struct(F.lit(0).alias("start"), F.octet_length("piece").alias("end")))
    return hits.unionByName(back.join(parts.filter("twice").select("bucket", "p1", "p2"), ["bucket", "p1", "p2"], "left_anti")).unionByName(
        parts.filter("twice").select("bucket", "p1", "p2", whole.alias("ranges")))


def _entries(rows: DataFrame, column: str) -> int:
    """Rows and array entries of a stage table, which bound its size."""
    n, entries = rows.agg(F.count("*"), F.sum(F.size(column))).first()
    return n + (entries or 0)


def repeat_spans(docs: DataFrame, length: int = LENGTH, within: DataFrame | None = None) -> DataFrame:
    """k1, k2 (keys of a text) and ``spans``: byte ranges [start, end) of the
    repeats, by start, of every distinct text that has any.  ``within`` is
    the result for a smaller length: a longer repeat lies inside a range of
    it, so nothing else is looked at."""
    st = Stages(docs.sparkSession, "suffix")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *_text_keys(F.col("text").cast("string")))
    if within is None:
        runs = st.put(bucket_runs(docs, length), "runs")
    else:
        n = _entries(within, "spans")
        runs = st.put(bucket_runs(docs.join(broadcast_if_small(within, n, BROADCAST_ENTRIES), KEYS), length), "runs")
    # Two texts, two places in one text, or a run that may repeat itself.
    more = (F.min("k1") < F.max("k1")) | (F.min("first") < F.max("first")) | (F.max("weight") > 1)
    repeated = st.put(runs.groupBy("bucket").agg(more.alias("more")).filter("more").drop("more"), "buckets")
    # A text's first window starts one run, so these tell how often it is there.
    copies = st.put(runs.groupBy(*KEYS).agg(F.sum((F.col("first") == 0).cast("long")).alias("n"), F.max("last").alias("last"))
                    .filter("n > 1").drop("n"), "copies")
    todo = st.put(runs.join(broadcast_if_small(repeated, repeated.count(), BROADCAST_BUCKETS), "bucket").groupBy(*KEYS)
                  .agg(F.collect_set(F.struct("bucket", "first", "last")).alias("runs"), F.min("doc_id").alias("one")), "todo")
    st.drop("runs", "buckets")
    todo = broadcast_if_small(todo, _entries(todo, "runs"), BROADCAST_ENTRIES)
    # The pieces of equal texts are taken from that with the smallest doc_id.
    one = [docs["k1"] == todo["k1"], docs["k2"] == todo["k2"], docs["doc_id"].eqNullSafe(todo["one"])]
    found = st.put(_pieces(docs.join(todo, one).select(docs["k1"], docs["k2"], "text", "runs"), length).withColumn("gram", F.col("bucket")), "pieces")
    st.drop("todo")
    once = st.put(_once(found), "once")
    hits = st.put(_hits(once, length, st), "hits")
    spans = _shifted(found.drop("piece", "gram"), hits, *KEYS).join(copies, KEYS, "left_anti").withColumnRenamed("ranges", "spans")
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), (F.col("last") + length).cast("int").alias("end")))
    spans = st.put(spans.unionByName(copies.select(*KEYS, all_of_it.alias("spans"))), "spans")
    st.drop(*[n for n in st.paths if n != "spans"])
    return spans


def _join_spans(rows: DataFrame, found: DataFrame, text: F.Column, name: str) -> DataFrame:
    """``rows`` with the spans of their texts as a column ``name``."""
    small = broadcast_if_small(found, _entries(found, "spans"), BROADCAST_ENTRIES).select(F.col("spans").alias(name), *(F.col(k).alias(f"{name}{k}") for k in KEYS))
    return rows.join(small, [k == F.col(f"{name}{n}") for n, k in zip(KEYS, _text_keys(text))], "left").drop(*(f"{name}{k}" for k in KEYS))


def remove_repeats(docs: DataFrame, length: int = LENGTH, passage: int | None = None) -> DataFrame:
    """All columns of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``removed`` (their [start, end) ranges),
    ``kept_bytes`` (what is left, concatenated) and ``kept_text`` (the same as
    text, without parts of characters at a cut; null if nothing is cut).
    ``n_passage``: bytes under repeats of the shorter length ``passage``,
    which are not removed (null without ``passage``).
    Columns of ``docs`` with one of these names are replaced."""
    shorter = repeat_spans(docs, passage) if passage else None
    found = repeat_spans(docs, length, shorter)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"))
    text = F.col("__row.text").cast("string")
    joined = _join_spans(row, found, text, "__spans")
    joined = _join_spans(joined, shorter, text, "__short") if passage else joined.withColumn("__short", F.lit(None).cast("array<struct<start:int,end:int>>"))

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("__row").field("text"))
        raw = data.tobytes()
        removed, kept, texts = [], [], []
        for i, found_ in enumerate(batch.column("__spans").to_pylist()):
            runs = merged(found_)
            text = raw[offs[i]:offs[i + 1]]
            at, parts = 0, []
            for r in runs:
                parts.append(text[at:r["start"]])
                at = r["end"]
            parts.append(text[at:])
            kept.append(b"".join(parts))
            texts.append(kept[-1].decode("utf-8", "ignore") if runs else None)
            removed.append(runs)
        n = np.diff(offs)
        size = lambda spans: sum(s["end"] - s["start"] for s in spans)
        gone = [size(r) for r in removed]
        short = [size(merged(x)) if passage else None for x in batch.column("__short").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("__row"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(r) for r in removed], pa.int64()),
             pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary()), pa.array(texts, pa.string()), pa.array(short, pa.int64())],
            names=["__row", "n_bytes", "n_removed", "n_spans", "removed", "kept_bytes", "kept_text", "n_passage"])

    made = StructType.fromDDL("n_bytes long, n_removed long, n_spans long, "
                              "removed array<struct<start:int,end:int>>, kept_bytes binary, kept_text string, n_passage long")
    out = map_text(joined.select("__row", "__spans", "__short"), fn, StructType([joined.schema["__row"], *made.fields]))
    made = ["n_bytes", "n_removed", "n_spans", "removed", "kept_bytes", "kept_text", "n_passage"]
    return out.select(*[F.col("__row")[c].alias(c) for c in docs.columns if c not in made], *made)
