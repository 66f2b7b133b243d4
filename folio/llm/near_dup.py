"""MinHash near-duplicate classes by an inverted join on signature coordinates.

Method
  1. Every text becomes a set of hashed word shingles (A-Z lower-cased, words
     split on x20 and x09-x0D, each text whole) and a signature of K MinHash
     values.  Texts with equal sets are one class from here on.
  2. Classes are posted under every (coordinate, value).  Posting sizes give
     one global order of the coordinate values, rarest first.  Two classes
     that agree in at least T coordinates must meet under one of the first
     ``shared - T + 1`` of the coordinate values that each shares with any
     class (prefix filter); classes sharing fewer than T values drop out.
     The long postings behind the prefix are skipped: they are never merged,
     and only probed when the collisions of a candidate pair are counted.
  3. Classes under one prefix posting are joined to its smallest member, not
     to each other; the components of these links are candidate clusters.
     A cluster is dealt out as pairs of bounded blocks.  A task counts the
     coordinate collisions of the pairs of its blocks that are not yet
     connected, and confirms those with T or more on the full shingle sets.
     It returns a spanning forest of the confirmed links, never all pairs.
  4. Components of the confirmed links give the class of every document.

A pair at the similarity threshold 0.85 agrees in T = 42 of K = 64
coordinates with probability over 0.9999; pairs above it more surely.

Defined results: a null or wordless text has no shingles and is linked with
nothing; texts shorter than a shingle are one shingle.  Rows that repeat a
doc_id are one document for linking and all come back.  A row without doc_id
takes part through its text, gets the component of the smallest doc_id it is
linked with (null if there is none) and is not ``kept`` unless alone.
(``keep_one`` goes by texts, see there.)  Columns besides doc_id and text are
ignored.  An empty table gives none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import wordhash as wh
from folio.llm.common import Stages, broadcast_if_small, grouped_stream, map_text, release_memory, row_chunks, text_bytes
from folio.llm.graph import connected_components

COORDINATES = 64
MATCHES = 42
BLOCK_ROWS = 256
BLOCK_SHINGLES = 250_000
BROADCAST_IDS = 2_000_000

_RNG = np.random.default_rng(97)
_MULT = _RNG.integers(1, 2**32, COORDINATES, dtype=np.uint32) | np.uint32(1)
_XOR = _RNG.integers(0, 2**32, COORDINATES, dtype=np.uint32)


def shingle_sets(texts: pa.Array, size: int):
    """Sorted distinct shingle hashes of every row, in order."""
    data, offs = text_bytes(texts)
    for lo, hi in row_chunks(offs):
        part = wh.LOWER[data[offs[lo]:offs[hi]]]
        starts, ends, rows = wh.words(part, offs[lo:hi + 1] - offs[lo])
        h = wh.word_hashes(part, starts, ends)
        long = wh.window_hashes(h, size)
        for i in range(hi - lo):
            a, b = rows[i], rows[i + 1]
            if b - a >= size:
                yield np.unique(long[a:b - size + 1])
            elif b > a:
                yield wh.window_hashes(h[a:b], int(b - a))
            else:
                yield h[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """K MinHash values: minima of K permutations of the upper hash halves."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 4096):
        part = (h[None, i:i + 4096] ^ _XOR[:, None]) * _MULT[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def signatures(docs: DataFrame, size: int, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``ids``, n_shingles, fingerprint of the set (f1, f2) and signature."""

    def fn(batch: pa.RecordBatch):
        n, f1, f2, sigs = [], [], [], []
        for s in shingle_sets(batch.column("text"), size):
            d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
            n.append(len(s))
            f1.append(d[0])
            f2.append(d[1])
            sigs.append(signature(s).view(np.int32))
        flat = pa.array(np.concatenate(sigs))
        offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * COORDINATES)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ids), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
             pa.ListArray.from_arrays(offsets, flat)],
            names=[*ids, "n_shingles", "f1", "f2", "sig"])

    return map_text(docs.select(*(F.col(c).cast("long") for c in ids), F.col("text").cast("string")), fn,
                    "".join(f"{c} long, " for c in ids) + "n_shingles long, f1 long, f2 long, sig array<int>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """node and its shingle set as little-endian 64-bit words."""

    def fn(batch: pa.RecordBatch):
        sets = [s.tobytes() for s in shingle_sets(batch.column("text"), size)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return map_text(docs, fn, "node long, shingles binary")


def block_links(sig: np.ndarray, sets: list[np.ndarray], block: np.ndarray, percent: int,
                matches: int) -> list[tuple[int, int]]:
    """Confirmed links among the rows of two blocks (or within one), as a
    spanning forest: pairs already connected here are not compared again."""
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    size = np.array([len(s) for s in sets])
    one_block = block.min() == block.max()
    found = []
    for x in range(len(sets)):
        rest = np.arange(x + 1, len(sets))
        ok = 100 * np.minimum(size[rest], size[x]) >= percent * np.maximum(size[rest], size[x])
        if not one_block:
            ok &= block[rest] != block[x]
        rest = rest[ok]
        if not len(rest):
            continue
        hits = (sig[rest] == sig[x]).sum(axis=1)
        rest, hits = rest[hits >= matches], hits[hits >= matches]
        for y in rest[np.argsort(-hits, kind="stable")].tolist():
            rx, ry = root(x), root(y)
            if rx == ry:
                continue
            small, large = (sets[x], sets[y]) if size[x] <= size[y] else (sets[y], sets[x])
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            if 100 * both >= percent * (size[x] + size[y] - both):
                parent[ry] = rx
                found.append((x, y))
    return found


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, matches: int = MATCHES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``.

    Links hold where 100 * intersection >= ``percent`` * union.  ``matches``
    of the 64 coordinates is the collision threshold; it suits percent >= 85.
    """
    st = Stages(docs.sparkSession, "near-dup")
    sigs = st.put(signatures(docs, shingle), "sigs")
    classes = st.put(
        sigs.filter("n_shingles > 0 and doc_id is not null").groupBy("f1", "f2")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string"))

    def texts_of(members: DataFrame, n_members: int) -> DataFrame:
        ids = broadcast_if_small(members.select("node").distinct(), n_members, BROADCAST_IDS)
        return texts.join(ids, "node", "left_semi")

    linked = linked_classes(classes, texts_of, st, shingle, percent, matches)
    ids = classes.select("f1", "f2", "node").join(linked, "node", "left").select(
        "f1", "f2", F.coalesce("component", "node").alias("class_id"))
    ids = st.put(ids, "ids")
    st.drop("linked", "classes")
    out = sigs.drop("sig").join(ids, ["f1", "f2"], "left")
    component = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def linked_classes(classes: DataFrame, texts_of, st: Stages, shingle: int, percent: int, matches: int) -> DataFrame:
    """node and component of every class (node, n, sig, f1, f2) that is linked
    with another.  ``texts_of(members, rows)`` gives node and text of them."""
    # Postings: one row per class and coordinate; values held once are dropped.
    tokens = classes.select("node", F.posexplode("sig").alias("k", "v")).select(
        "node", (F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))).alias("token"))
    counts = st.put(tokens.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1"), "counts")
    ranked = (tokens.join(counts, "token").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("shared"))
              .filter(F.size("shared") >= matches))
    postings = st.put(
        ranked.select("node", F.explode(F.slice("shared", F.lit(1), F.size("shared") - F.lit(matches - 1))).alias("p"))
        .select("node", F.col("p.token").alias("token")), "postings")

    pivots = st.put(postings.groupBy("token").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
                    .filter("pivot < top").drop("top"), "pivots")
    stars = postings.join(pivots, "token").filter("node > pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    clusters = st.put(connected_components(stars, st, "cluster"), "clusters")
    st.drop("counts", "postings", "pivots")

    # Clusters are cut into blocks of bounded rows and shingles.
    nodes = st.put(clusters.join(classes.groupBy("node").agg(F.max("n").alias("n")), "node"), "nodes")
    cuts = st.put(
        nodes.groupBy("component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
        .select("component", F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).alias("blocks")), "cuts")
    members = st.put(nodes.join(cuts, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))), "members")
    n_members = members.count()
    sets = full_sets(texts_of(members, n_members).select("node", "text"), shingle)
    # A doc_id may stand for several texts: each set joins its own class.
    held = classes.select("node", "n", "sig", "f1", "f2")
    full = st.put(sets.withColumn("n", F.expr("octet_length(shingles) div 8")), "sets")
    rows = (members.drop("n").join(held, "node").join(full, ["node", "n"])
            .select("component", "node", "block", "sig", "shingles",
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
            .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "node", "block", "sig", "shingles"))
    keys = ["component", "i", "j"]

    def confirm(batches):
        for g in grouped_stream(batches, keys):
            sets_ = [np.frombuffer(b, np.uint64) for b in g["shingles"]]
            sig = np.array(g["sig"], np.int32)
            pairs = block_links(sig, sets_, np.array(g["block"]), percent, matches)
            if pairs:
                a, b = ([g["node"][p[e]] for p in pairs] for e in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        release_memory()

    links = st.put(rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(confirm, "a long, b long"), "links")
    linked = st.put(connected_components(links, st, "final"), "linked")
    st.drop("clusters", "nodes", "cuts", "members", "sets", "links")
    return linked


def keep_one(docs: DataFrame, shingle: int = 3, percent: int = 85, matches: int = MATCHES) -> DataFrame:
    """The rows of ``docs`` that are the one kept document of their group: the
    smallest doc_id's.  Every distinct shingle set is a node of its own, so
    rows that share a doc_id but not the text are grouped by their texts
    alone; of rows that repeat a doc_id and its set (or are wordless) one
    stays.  Rows without doc_id all stay."""
    st = Stages(docs.sparkSession, "near-dup-keep")
    keys = ["doc_id", "doc_key"]
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("doc_key"), F.col("text").cast("string")).filter("doc_id is not null")
    sigs = st.put(signatures(keyed, shingle, ("doc_id", "doc_key")), "sigs")
    classes = st.put(
        sigs.filter("n_shingles > 0").groupBy("f1", "f2")
        .agg(F.min(F.struct(*keys)).alias("one"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
        .select(F.col("f1").alias("node"), "f1", "f2", "n", "sig", "one.*"), "classes")

    def texts_of(members: DataFrame, n_members: int) -> DataFrame:
        ids = classes.select("node", *keys).join(members.select("node"), "node")
        return keyed.join(broadcast_if_small(ids, n_members, BROADCAST_IDS), keys)

    linked = linked_classes(classes, texts_of, st, shingle, percent, matches)
    one = F.min(F.struct("doc_id", "f1", "f2")).alias("one")
    best = (classes.join(linked, "node", "left").groupBy(F.coalesce("component", "node").alias("c")).agg(one)
            .select("one.*", F.lit(True).alias("best")))
    rows = sigs.groupBy(*keys, "f1", "f2").agg(F.count("*").alias("n"), F.max("n_shingles").alias("words"))
    first = F.min("doc_key").over(Window.partitionBy("doc_id", "f1", "f2"))
    kept = (F.col("words") == 0) | F.col("best").isNotNull()
    verdict = st.put(rows.withColumn("first", first).join(best, ["doc_id", "f1", "f2"], "left")
                     .select(F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key"), "n", (kept & (F.col("doc_key") == F.col("first"))).alias("kept")),
                     "verdict")
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    gone = verdict.filter("not kept").select("__id", "__key")
    out = docs.join(broadcast_if_small(gone, gone.count(), BROADCAST_IDS), same, "left_anti")
    again = verdict.filter("kept and n > 1").select("__id", "__key")
    n_again = again.count()
    if n_again:
        again = broadcast_if_small(again, n_again, BROADCAST_IDS)
        first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
        single = out.join(again, same, "left_semi").withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
        out = out.join(again, same, "left_anti").unionByName(single)
    return out
