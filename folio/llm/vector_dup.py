"""Near-duplicate vectors by a pivot-permutation index.

Method
  1. Vectors that are equal component by component (by a 128-bit hash) are
     one class.
  2. Reference points (pivots): classes from a bounded sample, the smallest
     hashes, no two of them closer than ``APART``, filled up with random
     directions.  A hot group of near copies thus gives one pivot at most.
     Every class is described by its ``NEAREST`` nearest pivots.
  3. Inverted pivot lists.  Two vectors are candidates if their descriptions
     share at least ``SHARED`` = 3 pivots, so each class is posted under every
     three of its pivots and candidates meet in a list.  A pair that shares
     more would meet in several lists; it belongs to that of its three
     smallest shared pivots (rarest first).  Lists in which no pair belongs
     (one class, or classes that all have the same smaller pivot) are dropped
     before any vector is moved.
  4. A list is cut into bounded blocks, dealt out as pairs of blocks.  A task
     counts the shared pivots of each pair there (a product of the pivots'
     indicator vectors), verifies the cosine in double precision, and returns
     a count of links per class and a spanning forest of them, never pairs.
  5. Components of the forest give the classes their component.

The number of pivots grows with the cube root of the number of classes, so
lists stay short.  A pair at cosine 0.95 exactly is found with probability
0.991 at 1,024 pivots in 64 dimensions (0.98 and closer: over 0.999); a pair
below the threshold is never returned.

Defined results: vectors that are null, zero (or empty) or hold a null or
non-finite component link with nothing.  A shorter vector counts as 0 beyond
its end.  Every row is a vector: rows that repeat a vec_id all come back, and
equal vectors are links of each other.  A row without vec_id takes part; its
component is the smallest vec_id that it reaches (null if there is none) and
it is kept only if there is none.  Further columns are ignored.  An empty
table gives none.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import Stages, broadcast_if_small, grouped_stream, release_memory
from folio.llm.dense import finite, matrix, padded, spread
from folio.llm.graph import connected_components

COSINE = 0.95
NEAREST, SHARED = 8, 3
LEAST_PIVOTS, SAMPLE, APART = 1024, 4096, 0.8
BLOCK_ROWS = 512
BROADCAST_ROWS = 1_000_000


def normalised(v: np.ndarray) -> np.ndarray:
    """Rows at length 1 (scaled by their largest component first, so that no
    square overflows or vanishes)."""
    v = v.astype(float)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def pivot_count(classes: int) -> int:
    """A power of two that keeps the lists of three pivots at two classes on
    average at most."""
    count = LEAST_PIVOTS
    while count**3 < 168 * classes:
        count *= 2
    return count


def choose_pivots(sample: np.ndarray, count: int, width: int) -> np.ndarray:
    """Rows of the sample, each less than ``APART`` to those before it; random
    directions where they are too few."""
    out = np.zeros((count, width))
    n = 0
    for u in sample:
        if n < count and (n == 0 or (out[:n] @ u).max() < APART):
            out[n] = u
            n += 1
    rest = np.random.default_rng(13).normal(size=(count - n, width))
    out[n:] = rest / np.linalg.norm(rest, axis=1, keepdims=True)
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of a binary column of little-endian doubles, as unit vectors."""
    raw = column.to_pylist() if isinstance(column, (pa.Array, pa.ChunkedArray)) else column
    return normalised(np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1))


def _descriptions(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """node, near (pivots, nearest first)."""
    most = min(NEAREST, len(pivots))

    def run(batches):
        for batch in batches:
            v = matrix(batch.column("v"))
            for lo in range(0, len(v), 1024):
                s = normalised(v[lo:lo + 1024]) @ pivots.T
                near = np.argpartition(-s, most - 1, axis=1)[:, :most]
                near = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1, kind="stable"), 1)
                part = batch.slice(lo, 1024)
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * most)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(offsets, pa.array(near.ravel(), pa.int32()))],
                                                 names=["node", "near"])
        release_memory()

    return classes.select("node", "v").mapInArrow(run, "node long, near array<int>")


def _postings(described: DataFrame, pivots: int) -> DataFrame:
    """key, node and low: one row per three pivots (ranks, rarest first) of a
    class.  ``low`` is its smallest rank below the last one of the three and
    not among them; a number of its own if there is none."""
    triples = []
    for key in itertools.combinations(range(NEAREST), SHARED):
        low = next((i for i in range(key[-1]) if i not in key), None)
        name = sum((F.col("ranks")[i].cast("long") * pivots ** (SHARED - 1 - at) for at, i in enumerate(key)), F.lit(0).cast("long"))
        triples.append(F.struct(name.alias("key"), (F.col("ranks")[low].cast("long") if low is not None else -1 - F.col("node")).alias("low")))
    return described.select("node", F.explode(F.array(*triples)).alias("p")).select("p.key", "node", "p.low")


def verify(unit: np.ndarray, ranks: np.ndarray, weight: np.ndarray, block: np.ndarray, key: np.ndarray,
           cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links among the rows of two blocks of the list ``key`` (or within its
    one block) that belong to this list: number of linked vectors per row,
    and a spanning forest."""
    n = len(unit)
    first, second = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    # Shared pivots below the last one of the list, beside the list's own.
    below = (ranks < key[-1]) & ~np.isin(ranks, key)
    used, at = np.unique(ranks[below], return_inverse=True)
    has = np.zeros((n, len(used)), np.float32)
    has[np.nonzero(below)[0], at] = 1
    linked = (unit[first] @ unit[second].T >= cosine) & (has[first] @ has[second].T == 0)
    if block.min() == block.max():
        np.fill_diagonal(linked, False)
        count = linked @ weight
        a, b = np.nonzero(np.triu(linked))
    else:
        count = np.zeros(n, np.int64)
        count[first] = linked @ weight[second]
        count[second] = linked.T @ weight[first]
        a, b = np.nonzero(linked)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for x, y in zip(first[a].tolist(), second[b].tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[ry] = rx
            forest.append((x, y))
    return count, forest


def _links(classes: DataFrame, described: DataFrame, pivots: int, cosine: float, st: Stages) -> DataFrame:
    """node, links (of a class and a list), other (an end of a forest link)."""
    postings = _postings(described, pivots)
    lists = (postings.groupBy("key").agg(F.min("low").alias("a"), F.max("low").alias("b"), F.count("*").alias("n"))
             .filter("a < b").select("key", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks")))
    lists = st.put(lists, "lists")
    held = postings.drop("low").join(broadcast_if_small(lists, lists.count(), BROADCAST_ROWS), "key")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    rows = (held.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block"))
    data = classes.join(described, "node").select("node", "ranks", F.col("copies").alias("weight"), "raw")
    keys = ["key", "i", "j"]
    rows = rows.join(data, "node").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        node, links, other = [], [], []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, links, other)], names=["node", "links", "other"])

        for g in grouped_stream(batches, keys):
            if len(g["node"]) < 2:
                continue
            k = g["key"][0]
            key = np.array([k // pivots**2, k // pivots % pivots, k % pivots])
            count, forest = verify(_vectors(g["raw"]), np.array(g["ranks"]), np.array(g["weight"]), np.array(g["block"]), key, cosine)
            some = np.flatnonzero(count)
            node += [g["node"][i] for i in some] + [g["node"][x] for x, _ in forest]
            links += count[some].tolist() + [0] * len(forest)
            other += [None] * len(some) + [g["node"][y] for _, y in forest]
            if len(node) > 50_000:
                yield out()
                node, links, other = [], [], []
        if node:
            yield out()
        release_memory()

    return rows.mapInArrow(run, "node long, links long, other long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``
    (vec_id, embedding)."""
    st = Stages(vectors.sparkSession, "vector-dup")
    v = F.col("embedding").cast("array<double>")
    some = vectors.select(F.col("vec_id").cast("long"), v.alias("v"))
    usable = finite(F.col("v")) & F.coalesce(F.exists("v", lambda c: c != 0.0), F.lit(False))
    # -0.0 equals 0.0.
    plain = F.transform("v", lambda c: F.when(c == 0.0, F.lit(0.0)).otherwise(c))
    rows = st.put(some.select("vec_id", F.when(usable, plain).alias("v")), "rows")
    width, short = rows.agg(F.max(F.size("v")), F.min(F.size("v"))).first()
    width = width or 0
    if width > 0 and short != width:
        rows = rows.withColumn("v", padded(F.col("v"), width, 0.0))
    there = F.col("v").isNotNull()
    rows = rows.withColumn("f1", F.when(there, F.xxhash64("v"))).withColumn("f2", F.when(there, F.xxhash64(F.lit(7), "v")))
    groups = (rows.filter("f1 is not null").groupBy("f1", "f2")
              .agg(F.count("*").alias("copies"), F.min("vec_id").alias("id"), F.first("v").alias("v")))
    classes = st.put(groups, "groups")
    n = classes.count()
    classes = st.put(spread(classes, n).withColumn("node", F.monotonically_increasing_id()).withColumn("raw", _raw(F.col("v"))), "classes")
    st.drop("groups")

    pivots = pivot_count(n)
    sample = classes.select("f1", "f2", "v").orderBy("f1", "f2").limit(SAMPLE).collect()
    points = choose_pivots(normalised(np.array([r.v for r in sample])) if sample else np.zeros((0, width)), pivots, max(1, width))
    if n:
        described = st.put(_descriptions(classes, points), "near")
        held = dict(described.select(F.explode("near").alias("p")).groupBy("p").agg(F.count("*")).collect())
        rank = np.empty(pivots, int)
        rank[sorted(range(pivots), key=lambda p: (held.get(p, 0), p))] = np.arange(pivots)
        order = F.lit(rank.tolist()).cast("array<int>")
        described = st.put(described.select("node", F.array_sort(F.transform("near", lambda p: order[p])).alias("ranks")), "ranks")
        links = st.put(_links(classes.drop("v"), described, pivots, cosine, st), "links")
        st.drop("near", "ranks", "lists")
    else:
        links = vectors.sparkSession.createDataFrame([], "node long, links long, other long")

    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    component = connected_components(links.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")), st)
    ends = classes.select("node", "f1", "f2", "id", "copies").join(counts, "node", "left").join(component, "node", "left")
    ends = ends.filter("links > 0 or copies > 1").withColumn("component", F.coalesce("component", "node"))
    ends = st.put(ends, "ends")
    least = ends.groupBy("component").agg(F.min("id").alias("component_id"))
    table = st.put(ends.join(least, "component").select(
        F.col("f1").alias("__f1"), F.col("f2").alias("__f2"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("found"), "component_id"), "table")
    st.drop("classes", "ends", *(["links"] if n else []))
    out = rows.drop("v").join(broadcast_if_small(table, table.count(), BROADCAST_ROWS),
                              [F.col("f1") == F.col("__f1"), F.col("f2") == F.col("__f2")], "left")
    component = F.when(F.col("found").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("found", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))


def _raw(v):
    """Little-endian doubles of an array column, as one binary value."""

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for x in np.ascontiguousarray(matrix(column), "<f8")], pa.binary())

    return run(v)
