"""Approximate top-k by random-projection buckets with an exact re-rank (V7).

An index is a Parquet table written once and reused by every search.  In each
of ``tables`` hash tables an item lies in the bucket of the random direction
that its unit vector projects on furthest; the table is partitioned by hash
table and bucket, so a search reads only the buckets it probes.  A bucket
beyond ``BLOCK_ROWS`` items is dealt out over several blocks, so a hot bucket
is scored by several tasks.

A search probes, per hash table, the buckets of the ``probes`` directions that
the query projects on furthest, scores all their items exactly (cosine) and
keeps the best k.  Nothing is sampled or capped inside a bucket: what can be
missed is only an item in no probed bucket.  :func:`choose_probes` measures
that on a bounded sample of queries and returns the least number of probes
that reaches a wanted recall; :func:`recall` compares a search with the exact
one.

Zero vectors score 0.  Items and queries without a vector take no part; all
vectors must have the index's dimension.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.operators.vectors import SCORE_DIGITS, _BestK, _stack, top_k_similar
from folio.session import reliable_checkpoint

TABLES, BUCKETS = 2, 128
BLOCK_ROWS = 100_000
SAMPLE_QUERIES = 128
RECALL = 0.93


@dataclass
class Index:
    """Where an index lies, and what its buckets were made with."""

    path: str
    item_id: str
    tables: int
    buckets: int
    dim: int
    seed: int

    def directions(self) -> np.ndarray:
        r = np.random.default_rng(self.seed).normal(size=(self.tables, self.buckets, self.dim))
        return r / np.linalg.norm(r, axis=2, keepdims=True)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/items")

    def blocks(self, spark: SparkSession) -> DataFrame:
        """tbl, bucket, blocks: at most one row per bucket of the index."""
        return spark.read.parquet(f"{self.path}/blocks")


def unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def _bucketed(df: DataFrame, key: str, vec: str, index: Index, probes: int) -> DataFrame:
    """key, vector (unit), tbl and bucket: one row per hash table and probed
    bucket (an item's own bucket with one probe)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        directions = index.directions()
        for pdf in batches:
            u = unit(_stack(pdf[vec]))
            if not len(u):
                continue
            for t, d in enumerate(directions):
                near = np.argsort(-(u @ d.T), axis=1, kind="stable")[:, :probes]
                row = np.repeat(np.arange(len(u)), near.shape[1])
                yield pd.DataFrame({key: pdf[key].to_numpy()[row], "vector": [u[i] for i in row], "tbl": np.int32(t), "bucket": near.ravel().astype(np.int32)})

    return df.select(key, vec).where(F.col(vec).isNotNull()).mapInPandas(run, f"{key} {kind}, vector array<double>, tbl int, bucket int")


def build_index(items: DataFrame, path: str, item_id: str = "id", item_vec: str = "vector", tables: int = TABLES,
                buckets: int = BUCKETS, seed: int = 29) -> Index:
    """Write the index of all ``items`` to the new folder ``path``."""
    spark = items.sparkSession
    dim = items.agg(F.max(F.size(item_vec))).first()[0] or 0
    index = Index(path, item_id, tables, buckets, dim, seed)
    if not dim:  # no vectors: nothing to write, and searches find nothing
        return index
    _bucketed(items, item_id, item_vec, index, 1).write.parquet(f"{path}/staged")
    staged = spark.read.parquet(f"{path}/staged")
    # Bucket sizes first, so that a hot bucket is dealt out when it is written.
    sizes = staged.groupBy("tbl", "bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    sizes.coalesce(1).write.parquet(f"{path}/blocks")
    cells = staged.join(F.broadcast(index.blocks(spark)), ["tbl", "bucket"])  # tables x buckets rows at most
    cells = cells.withColumn("block", F.pmod(F.xxhash64(item_id), F.col("blocks")).cast("int")).drop("blocks")
    cells.repartition("tbl", "bucket", "block").write.partitionBy("tbl", "bucket").parquet(f"{path}/items")
    return index


def top_k_approx(queries: DataFrame, index: Index, k: int, probes: int, query_id: str = "qid", query_vec: str = "vector",
                 exclude_self: bool = False) -> DataFrame:
    """query_id, item id, score, rank and n_scored (items scored for the
    query, an item once per hash table that finds it).  ``exclude_self``
    leaves out the item whose id is the query's."""
    spark, item = queries.sparkSession, index.item_id
    if not index.dim:
        kind = queries.schema[query_id].dataType.simpleString()
        return spark.createDataFrame([], f"{query_id} {kind}, {item} {kind}, score double, rank int, n_scored long")
    probed = _bucketed(queries, query_id, query_vec, index, min(probes, index.buckets)).withColumnRenamed("vector", "_query")
    probed = reliable_checkpoint(probed, "ann-probes")
    asked = probed.join(F.broadcast(index.blocks(spark)), ["tbl", "bucket"])
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    # Buckets that nobody asks for are not read (tables x buckets names at most).
    named: dict[int, list[int]] = {}
    for r in probed.select("tbl", "bucket").distinct().collect():
        named.setdefault(r["tbl"], []).append(r["bucket"])
    wanted = F.lit(False)
    for t, buckets in named.items():
        wanted = wanted | ((F.col("tbl") == t) & F.col("bucket").isin(buckets))
    items = index.read(spark).where(wanted)
    q_type, i_type = (df.schema[c].dataType.simpleString() for df, c in ((probed, query_id), (items, item)))

    def cell(qpdf: pd.DataFrame, ipdf: pd.DataFrame) -> pd.DataFrame:
        if not len(qpdf) or not len(ipdf):
            return pd.DataFrame({"_q": [], "_i": [], "score": [], "n": []})
        qids = qpdf[query_id].to_numpy(dtype=object)
        best = _BestK(qids, _stack(qpdf["_query"]), k + exclude_self, False, None)
        best.add(ipdf[item].to_numpy(dtype=object), _stack(ipdf["vector"]))
        q, i, s = best.rows()
        none = [None] * len(qids)  # one more row per query, for the count
        return pd.DataFrame({"_q": [*q, *qids], "_i": pd.Series([*i, *none], dtype=object), "score": [*s, *([np.nan] * len(qids))], "n": [0] * len(q) + [len(ipdf)] * len(qids)})

    keys = ["tbl", "bucket", "block"]
    found = asked.groupBy(*keys).cogroup(items.groupBy(*keys)).applyInPandas(cell, f"_q {q_type}, _i {i_type}, score double, n long")
    # One row per pair (both tables may find it), and the count of the query.
    pairs = found.groupBy("_q", "_i").agg(F.max("score").alias("score"), F.sum("n").alias("n"))
    scored = F.sum("n").over(Window.partitionBy("_q"))
    order = Window.partitionBy("_q").orderBy(F.col("score").desc_nulls_last(), F.col("_i"))
    pairs = pairs.withColumn("n_scored", scored)
    if exclude_self:
        pairs = pairs.where(~F.col("_i").eqNullSafe(F.col("_q")))
    return (pairs.where(F.col("_i").isNotNull()).withColumn("score", F.round("score", SCORE_DIGITS))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("_q").alias(query_id), F.col("_i").alias(item), "score", "rank", "n_scored"))


def choose_probes(queries: DataFrame, items: DataFrame, index: Index, k: int, target: float = RECALL, query_id: str = "qid",
                  query_vec: str = "vector", item_vec: str = "vector") -> int:
    """The least number of probes that finds ``target`` of the exact top k of
    ``SAMPLE_QUERIES`` queries (those with the smallest hashes)."""
    some = queries.where(F.col(query_vec).isNotNull()).orderBy(F.xxhash64(query_id), query_id).limit(SAMPLE_QUERIES)
    exact = top_k_similar(some, items, k, query_id=query_id, query_vec=query_vec, item_id=index.item_id, item_vec=item_vec)
    # k rows per sampled query: the two vectors of each.
    pairs = (exact.select(query_id, index.item_id)
             .join(some.select(query_id, F.col(query_vec).alias("_qv")), query_id)
             .join(items.select(index.item_id, F.col(item_vec).alias("_iv")), index.item_id).collect())
    if not pairs:
        return 1
    q, v = (unit(np.array([r[c] for r in pairs], float)) for c in ("_qv", "_iv"))
    need = np.full(len(pairs), index.buckets)
    for d in index.directions():
        own = (v @ d.T).argmax(axis=1)
        place = np.argsort(np.argsort(-(q @ d.T), axis=1, kind="stable"), axis=1)
        need = np.minimum(need, place[np.arange(len(pairs)), own] + 1)
    return int(np.sort(need)[max(0, int(np.ceil(target * len(need))) - 1)])


def recall(approx: DataFrame, exact: DataFrame, query_id: str, item_id: str) -> DataFrame:
    """query_id, n_exact, n_hits: how much of the exact top k was found."""
    hit = approx.select(query_id, item_id).withColumn("_hit", F.lit(1))
    return exact.join(hit, [query_id, item_id], "left").groupBy(query_id).agg(
        F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_hits"))
