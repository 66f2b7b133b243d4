"""Hard negatives of anchor vectors, scored exactly by the Four-Russians
method.

A component x becomes the whole number floor(256 x); a row's score is its
inner product with the anchor.  For every anchor and each of its positives
(its best rows of the same label) the best rows of other labels are returned
whose score lies within a band around the positive's score.

Method
  1. Every row is packed once: the bits of its components (two's complement)
     are laid out plane by plane, eight dimensions to a byte.
  2. Anchors are taken in chunks of about ``CHUNK``.  For every group of
     eight dimensions a task tabulates the sums of all 256 subsets of an
     anchor's eight components (by doubling).  The byte of a row's plane is
     the index of its subset: eight components are scored by one lookup, and
     the planes are combined by shift and add, the sign plane subtracted.
     Nothing is approximate, so no score is computed again.
  3. First scan of a chunk: rows against the anchors of their own label,
     which gives the positives.  Second scan: against those of other labels.
     Either keeps a running best per anchor (and positive) in the task, ties
     included, so a task returns a bounded number of rows per anchor.

A chunk's anchors and their positives are all that passes through the driver.

Defined results: rows with a null label, a null vector or a null or
non-finite component take no part, nor do rows without vec_id, which could
not be named.  Rows equal in vec_id, label and vector are one row; rows that
share only the vec_id are different rows, each an anchor or a candidate of
its own.  A shorter vector counts as 0 beyond its end.  256 x beyond the size
at which a score could leave 64 bits (2^28 at 64 dimensions) counts as that
size.  Ties go to the smaller vec_id.  Further columns are ignored.  An empty
table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import Stages, release_memory
from folio.llm.dense import finite, floored, matrix, padded, spread

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 10
#: Anchors of a chunk (about), of a table that is looked up at once, and rows
#: scored at once.
CHUNK, LOOKUP_ANCHORS, LOOKUP_ROWS = 4096, 256, 512
LEAST = np.iinfo(np.int64).min
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def pack(q: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit b of the two's complement of eight
    components each, lowest plane first."""
    groups = -(-q.shape[1] // 8)
    wide = np.zeros((len(q), groups * 8), np.int64)
    wide[:, :q.shape[1]] = q
    bits = (wide[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpack(packed: np.ndarray) -> np.ndarray:
    """The components again (padded to whole groups)."""
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    weight = np.int64(1) << np.arange(packed.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    return (bits * weight[None, :, None]).sum(axis=1)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): sums of every subset of eight components."""
    groups = anchors.shape[1] // 8
    out = np.zeros((groups, 256, len(anchors)), anchors.dtype)
    for g in range(groups):
        for bit in range(8):
            size = 1 << bit
            out[g, size:2 * size] = out[g, :size] + anchors[:, 8 * g + bit]
    return out


def scores(packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products by lookups, planes combined by shift
    and add from the sign plane down."""
    out = np.zeros((len(packed), sums.shape[2]), sums.dtype)
    for b in reversed(range(packed.shape[1])):
        out <<= 1
        plane = packed[:, b]
        for g in range(len(sums)):
            if b == packed.shape[1] - 1:
                out -= sums[g][plane[:, g]]
            else:
                out += sums[g][plane[:, g]]
    return out


class Best:
    """The best ``k`` (score, smaller id first) of every slot so far."""

    def __init__(self, k: int, slots: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, LEAST)

    def offer(self, score: np.ndarray, ok: np.ndarray, ids: np.ndarray, slots: np.ndarray) -> None:
        """Scores of rows (down) in distinct slots (across), where ``ok``."""
        ok = ok & (score >= self.least[slots])
        if len(ids) > self.k:
            full = np.flatnonzero(np.count_nonzero(ok, axis=0) > self.k)
            if len(full):
                part = np.where(ok[:, full], score[:, full], np.iinfo(score.dtype).min)
                ok[:, full] &= score[:, full] >= np.partition(part, len(ids) - self.k, axis=0)[len(ids) - self.k]
        r, c = np.nonzero(ok)
        if not len(r):
            return
        slot = np.concatenate([self.slot, slots[c]])
        value = np.concatenate([self.score, score[r, c].astype(np.int64)])
        who = np.concatenate([self.id, ids[r]])
        order = np.lexsort((who, -value, slot))
        slot, value, who = slot[order], value[order], who[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], value[keep], who[keep]
        last = rank == self.k - 1
        self.least[slot[last]] = value[last]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.slot, self.score, self.id)], names=["slot", "score", "id"])


class Chunk:
    """Anchors of one chunk, in order of their labels; shipped to the tasks."""

    def __init__(self, rows: list, planes: int, groups: int):
        rows = sorted(rows, key=lambda r: (r.label, r.vec_id, bytes(r.packed)))
        self.planes, self.groups = planes, groups
        self.ids = np.array([r.vec_id for r in rows], np.int64)
        self.labels = np.array([r.label for r in rows], np.int64)
        self.packed = [bytes(r.packed) for r in rows]
        self.parts = [np.arange(lo, min(lo + LOOKUP_ANCHORS, len(rows))) for lo in range(0, len(rows), LOOKUP_ANCHORS)]
        self.lo = self.hi = None

    def block(self, packed: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), self.planes, self.groups)

    def tables(self) -> list[np.ndarray]:
        out = []
        for part in self.parts:
            a = unpack(self.block([self.packed[i] for i in part]))
            # A score, and every partial sum of it, is within this.
            most = int(np.abs(a).sum(axis=1).max(initial=0)) << self.planes
            out.append(subset_sums(a.astype(np.int32 if most < 1 << 31 else np.int64)))
        return out

    def bands(self, positives: list) -> None:
        """Per anchor and place of its positive the band of the scores
        wanted: 30 p <= 100 s <= 90 p."""
        self.lo = np.ones((POSITIVES, len(self.ids)), np.int64)
        self.hi = np.zeros((POSITIVES, len(self.ids)), np.int64)
        for r in positives:
            self.lo[r.place - 1, r.slot] = -(-3 * r.score // 10)
            self.hi[r.place - 1, r.slot] = 9 * r.score // 10


def _batches(batches, chunk: Chunk):
    """Rows in blocks: packed bytes, vec_id, label."""
    for batch in batches:
        ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        packed = batch.column("packed").to_pylist()
        for at in range(0, len(ids), LOOKUP_ROWS):
            to = at + LOOKUP_ROWS
            yield chunk.block(packed[at:to]), ids[at:to], labels[at:to]


def _positives(rows: DataFrame, chunk: Chunk) -> DataFrame:
    """slot (anchor), score and id of the best rows of the anchor's label."""

    def run(batches):
        tables, best = chunk.tables(), Best(POSITIVES, len(chunk.ids))
        for packed, ids, labels in _batches(batches, chunk):
            order = np.argsort(labels, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1):
                first, last = np.searchsorted(chunk.labels, [labels[own[0]], labels[own[0]] + 1])
                for part, table in zip(chunk.parts, tables):
                    lo, hi = max(first, part[0]), min(last, part[-1] + 1)
                    if lo >= hi:
                        continue
                    slots = np.arange(lo, hi)
                    s = scores(packed[own], table[:, :, lo - part[0]:hi - part[0]])
                    ok = np.ones(s.shape, bool)
                    for i, a in np.argwhere(np.isin(ids[own], chunk.ids[slots])[:, None] & (ids[own][:, None] == chunk.ids[slots])):
                        ok[i, a] = packed[own[i]].tobytes() != chunk.packed[slots[a]]  # not the anchor itself
                    best.offer(s, ok, ids[own], slots)
        yield best.batch()
        release_memory()

    return rows.mapInArrow(run, "slot long, score long, id long")


def _negatives(rows: DataFrame, chunk: Chunk) -> DataFrame:
    """The same for rows of other labels, per anchor and place of its
    positive (slot = place - 1 times the anchors, plus the anchor)."""
    n = len(chunk.ids)

    def run(batches):
        tables, best = chunk.tables(), Best(NEGATIVES, POSITIVES * n)
        for packed, ids, labels in _batches(batches, chunk):
            for part, table in zip(chunk.parts, tables):
                s = scores(packed, table)
                other = labels[:, None] != chunk.labels[part]
                for place in range(POSITIVES):
                    best.offer(s, other & (s >= chunk.lo[place, part]) & (s <= chunk.hi[place, part]), ids, place * n + part)
        yield best.batch()
        release_memory()

    return rows.mapInArrow(run, "slot long, score long, id long")


def _ranked(found: DataFrame, k: int, place: str) -> DataFrame:
    """The best ``k`` of every slot over all tasks."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return found.withColumn(place, F.row_number().over(order)).filter(F.col(place) <= k)


def packed_rows(vectors: DataFrame, st: Stages) -> tuple[DataFrame, int, int]:
    """Rows that take part: vec_id, label, packed; planes and groups."""
    v = F.col("embedding").cast("array<double>")
    label = F.col("label").cast("long")
    some = vectors.select(F.col("vec_id").cast("long"), label.alias("label"), v.alias("v"))
    some = some.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    width = some.agg(F.max(F.size("v"))).first()[0] or 0
    most = 1 << (62 - max(1, width).bit_length()) // 2
    whole = st.put(some.select("vec_id", "label", padded(floored(F.col("v"), SCALE, float(most)), width, 0).cast("array<long>").alias("q")), "whole")
    top = whole.agg(F.max(F.greatest(F.array_max("q"), -F.array_min("q")))).first()[0] or 0
    planes, groups = int(top).bit_length() + 1, max(1, -(-width // 8))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix(batch.column("q"))
            for lo in range(0, len(q), 1024):
                part = batch.slice(lo, 1024)
                b = pack(q[lo:lo + 1024].astype(np.int64) if width else np.zeros((part.num_rows, 8), np.int64), planes)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array([x.tobytes() for x in b], pa.binary())],
                                                 names=["vec_id", "label", "packed"])

    rows = whole.mapInArrow(run, "vec_id long, label long, packed binary")
    rows = st.put(rows.groupBy("vec_id", "label", "packed").agg(F.count("*").alias("n")).drop("n"), "packed")
    st.drop("whole")
    return rows, planes, groups


def hard_negatives(vectors: DataFrame, anchor=None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score of the rows (vec_id, label, embedding) of ``vectors``.
    ``anchor`` is a condition on vec_id; by default it is divisible by 100."""
    spark = vectors.sparkSession
    st = Stages(spark, "hard-negatives")
    packed, planes, groups = packed_rows(vectors, st)
    rows = st.put(spread(packed, packed.count()), "rows")
    st.drop("packed")
    chosen = rows.filter(F.col("vec_id") % 100 == 0 if anchor is None else anchor)
    count = chosen.count()
    chunks = -(-count // CHUNK)
    if not chunks:
        return spark.createDataFrame([], OUT)
    anchors = st.put(chosen.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "packed"), F.lit(chunks))), "anchors")
    parts = []
    for i in range(chunks):
        chunk = Chunk(anchors.filter(F.col("chunk") == i).collect(), planes, groups)
        if not len(chunk.ids):
            continue
        best = st.put(_ranked(_positives(rows, chunk), POSITIVES, "place"), f"positives-{i}")
        chunk.bands(best.collect())
        n = len(chunk.ids)
        slot = F.col("slot")
        found = (_ranked(_negatives(rows, chunk), NEGATIVES, "rank")
                 .select((slot % n).alias("slot"), (F.floor(slot / n) + 1).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
                 .join(best.select("slot", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["slot", "place"]))
        names = spark.createDataFrame([(k, int(v)) for k, v in enumerate(chunk.ids)], "slot long, anchor_id long")
        columns = [F.col(c.split()[0]).cast(c.split()[1]) for c in OUT.split(", ")]
        parts.append(st.put(found.join(F.broadcast(names), "slot").select(*columns), f"found-{i}"))
        st.drop(f"positives-{i}")
    out = spark.read.schema(parts[0].schema).parquet(*(p for name, p in st.paths.items() if name.startswith("found-")))
    st.drop("rows", "anchors")
    return out
