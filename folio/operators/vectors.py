"""Semantic retrieval: text assembly, encoding, normalisation, exact top-k
(V1-V6, J7, L4).

Exact top-k of q queries against n vectors is O(q*n*d) work.  It is never
planned as a join that materialises (query, item) pairs.  Instead:

* **broadcast path** (query count checked against ``max_broadcast_queries``):
  the query block is shipped to every task once; each task multiplies its
  item batches by the query matrix in NumPy and keeps a running best k per
  query, ordered by (rounded score, id) as the result is, so a task returns
  at most k rows per query however many items tie.  The items are scanned
  once, not shuffled.
* **blocked path** (more queries than the bound): queries are split into
  blocks of at most the bound and items into blocks of ``item_block_rows``;
  the (query block, item block) cells are co-grouped and each cell does the
  same per-batch top-k.  Every group is bounded on both sides.

Both finish with a global ``row_number() <= k`` per query that Spark plans as
a partial ``WindowGroupLimit`` before the shuffle, so at most k rows per query
per task move.
"""

from __future__ import annotations

import heapq
import math
import os
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from folio.constants import DEFAULT_TOP_K, EMBED_COLUMNS, HASH_BUCKETS, TOKEN_SPLIT_PATTERN
from folio.functions import strip
from folio.session import reliable_checkpoint

SCORE_DIGITS = 6


# ---------------------------------------------------------------------------
# V1: semantic text
# ---------------------------------------------------------------------------


def semantic_text(df: DataFrame, cols: Sequence[str] = EMBED_COLUMNS, out: str = "semantic_text") -> DataFrame:
    """V1: stripped, non-blank text of ``cols`` in priority order, space-joined.

    Array columns are first joined with ', ' (as the flat export does).
    """
    parts = []
    for c in cols:
        if c not in df.columns:
            continue
        v = F.col(c)
        if df.schema[c].dataType.typeName() == "array":
            v = F.array_join(v, ", ")
        parts.append(F.nullif(strip(v.cast("string")), F.lit("")))
    return df.withColumn(out, F.concat_ws(" ", *parts))


# ---------------------------------------------------------------------------
# V2(a): hashed bag of words
# ---------------------------------------------------------------------------


def token_buckets(text: Column | str, buckets: int = HASH_BUCKETS) -> Column:
    """Array of bucket ids, one per token (lower-cased letter/digit runs).

    bucket = first 16 bits of the token's MD5, modulo ``buckets``.
    """
    t = F.col(text) if isinstance(text, str) else text
    tokens = F.filter(F.split(F.lower(t), TOKEN_SPLIT_PATTERN), lambda x: x != "")
    return F.transform(tokens, lambda tok: bucket_of(tok, buckets))


def bucket_of(token: Column, buckets: int = HASH_BUCKETS) -> Column:
    """Bucket id of one token: first 16 bits of its MD5, modulo ``buckets``
    (more than 65,536 buckets could never be reached and are refused)."""
    if buckets > 1 << 16:
        raise ValueError("at most 65536 buckets: the bucket is taken from 16 bits of the MD5")
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 4), 16, 10).cast("bigint"), F.lit(buckets))


def hashed_bag_of_words(
    df: DataFrame, id_col: str, text_col: str, buckets: int = HASH_BUCKETS
) -> DataFrame:
    """V2(a) sparse form: one (id, bucket, tf) row per non-zero bucket.

    Every document's tokens come from one input row, so the partial aggregate
    before the shuffle already reduces them to at most ``buckets`` rows per
    document; only those move.  Tokens are exploded before hashing so the MD5
    runs in generated code rather than inside a lambda.
    """
    tokens = df.select(id_col, F.explode(F.split(F.lower(text_col), TOKEN_SPLIT_PATTERN)).alias("_tok"))
    return (
        tokens.where(F.col("_tok") != "")
        .select(id_col, bucket_of(F.col("_tok"), buckets).alias("bucket"))
        .groupBy(id_col, "bucket")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


# Rows of an Arrow batch that a Python worker turns into vectors at a time.
BATCH_ROWS = 512


def bucket_counts(ids: Sequence, buckets: int = HASH_BUCKETS) -> np.ndarray:
    """Count matrix (rows x buckets) of a batch of bucket-id arrays, by one
    ``bincount`` per ``BATCH_ROWS`` rows."""
    out = np.zeros((len(ids), buckets))
    for i in range(0, len(ids), BATCH_ROWS):
        part = ids[i:i + BATCH_ROWS]
        sizes = np.array([0 if v is None else len(v) for v in part], dtype=np.int64)
        if sizes.sum():
            flat = np.concatenate([np.asarray(v, dtype=np.int64) for v in part if v is not None and len(v)])
            at = np.repeat(np.arange(len(sizes)) * buckets, sizes) + flat
            out[i:i + BATCH_ROWS] = np.bincount(at, minlength=len(sizes) * buckets).reshape(len(sizes), buckets)
    return out


def _bincount_udf(buckets: int):
    @F.pandas_udf(ArrayType(DoubleType()))
    def bincount(ids: pd.Series) -> pd.Series:
        return pd.Series(list(bucket_counts(ids, buckets)))

    return bincount


def term_buckets(
    df: DataFrame, id_col: str, text_col: str, buckets: int = HASH_BUCKETS, out: str = "vector"
) -> DataFrame:
    """V2(a) as bucket arrays: (id, one bucket per token); a missing text has
    none.  Scoring counts them inside its own task (``item_buckets``)."""
    none = F.array().cast("array<bigint>")
    return df.select(id_col, F.coalesce(token_buckets(text_col, buckets), none).alias(out))


def term_vectors(
    df: DataFrame, id_col: str, text_col: str, buckets: int = HASH_BUCKETS, out: str = "vector"
) -> DataFrame:
    """V2(a) dense form: (id, tf vector of length ``buckets``), no shuffle; a
    missing text has the zero vector.

    Tokenising and hashing run in the JVM; only the bucket count (one
    ``bincount`` per Arrow batch) runs in Python.
    """
    rows = term_buckets(df, id_col, text_col, buckets, out)
    return rows.select(id_col, _bincount_udf(buckets)(F.col(out)).alias(out))


# ---------------------------------------------------------------------------
# V2(b): pluggable dense encoder
# ---------------------------------------------------------------------------


def encode(
    df: DataFrame,
    id_col: str,
    text_col: str,
    encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]],
    out: str = "vector",
    cache_key: str | None = None,
) -> DataFrame:
    """V2(b): run a user-supplied text encoder over Arrow batches.

    ``encoder_factory`` returns ``encode(texts) -> (n, d) array``.  It is called
    once per task, or, with ``cache_key``, once per Python worker process:
    PySpark reuses workers across tasks, so a model loaded under a key stays
    in that worker for the following tasks.  ``text_col`` may also be an array
    (e.g. :func:`term_buckets`); the model then gets a list of arrays.  Output
    vectors are L2-normalised float arrays.

    The encoder gets at most ``BATCH_ROWS`` rows at a time, so that a worker
    holds the vectors of so many rows only, however large its Arrow batches.
    """
    schema = df.select(id_col).schema.add(out, ArrayType(FloatType()))
    is_text = df.schema[text_col].dataType.typeName() == "string"
    if cache_key is not None:
        df.sparkSession.sparkContext.addPyFile(os.path.join(os.path.dirname(os.path.dirname(__file__)), "folio_worker_cache.py"))

    def run(batches):
        if cache_key is None:
            model = encoder_factory()
        else:
            from folio_worker_cache import MODELS

            if cache_key not in MODELS:
                MODELS[cache_key] = encoder_factory()
            model = MODELS[cache_key]
        for pdf in batches:
            for i in range(0, len(pdf), BATCH_ROWS):
                part = pdf.iloc[i:i + BATCH_ROWS]
                texts = part[text_col].fillna("").astype(str).tolist() if is_text else part[text_col].tolist()
                mat = np.asarray(model(texts), dtype=np.float64)
                norms = np.linalg.norm(mat, axis=1, keepdims=True)
                mat = np.divide(mat, norms, out=np.zeros_like(mat), where=norms > 0)
                yield pd.DataFrame({id_col: part[id_col].values, out: list(mat.astype(np.float32))})

    return df.select(id_col, text_col).mapInPandas(run, schema)


# ---------------------------------------------------------------------------
# V3 / A10 / V6 / J7
# ---------------------------------------------------------------------------


def l2_normalize_vectors(df: DataFrame, vec: str = "embedding", out: str | None = None) -> DataFrame:
    """V3: L2-normalise an array column (double); zero vectors stay zero."""
    from folio.functions import l2_normalize

    return df.withColumn(out or vec, l2_normalize(vec))


def align_embeddings(ids: DataFrame, emb: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """The full outer join of an id table with an embedding table on ``key``.

    Returns key, has_id, has_vector, dimension: one row per embedding row,
    plus one per distinct id that has no embedding.  Both sides are read as
    key (plus vector size) only, so the shuffles carry no vector payload.

    It is planned as two one-sided joins instead of a full outer join, which
    adaptive execution cannot split when one key holds a large share of the
    embedding rows.  The embedding rows are the streamed side of a left outer
    join against the distinct ids (at most one row per key), which skew
    handling can split.  Ids without a vector come from an anti-join against
    the distinct embedding keys, which the partial aggregate reduces to one
    row per key per task before the shuffle.
    """
    distinct_ids = ids.select(key).distinct()
    with_vector = (
        emb.select(key, F.size(vec).alias("dimension"))
        .join(distinct_ids.withColumn("_l", F.lit(True)), on=key, how="left")
        .select(key, F.coalesce("_l", F.lit(False)).alias("has_id"), F.lit(True).alias("has_vector"), "dimension")
    )
    without_vector = distinct_ids.join(emb.select(key).distinct(), on=key, how="left_anti").select(
        key, F.lit(True).alias("has_id"), F.lit(False).alias("has_vector"), F.lit(None).cast("int").alias("dimension")
    )
    return with_vector.unionByName(without_vector)


def validate_embeddings(ids: DataFrame, emb: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """V6: one-row report: ids vs vectors (every row counted, repeats too),
    unmatched on each side, dimensions.  Valid: as many ids as vectors, none
    unmatched, one dimension."""
    aligned = align_embeddings(ids, emb, key, vec)
    n_ids = ids.agg(F.count(F.lit(1))).scalar()
    return aligned.agg(
        F.count_if("has_vector").alias("n_vectors"),
        F.count_if(F.col("has_id") & F.col("has_vector")).alias("n_matched"),
        F.count_if(F.col("has_id") & ~F.col("has_vector")).alias("n_ids_without_vector"),
        F.count_if(~F.col("has_id") & F.col("has_vector")).alias("n_vectors_without_id"),
        F.count_distinct("dimension").cast("bigint").alias("n_dimensions"),
    ).select(
        n_ids.alias("n_ids"),
        "*",
    ).withColumn(
        "valid",
        (F.col("n_ids") == F.col("n_vectors")) & (F.col("n_ids_without_vector") == 0)
        & (F.col("n_vectors_without_id") == 0) & (F.col("n_dimensions") <= 1),
    )


def require_aligned(ids: DataFrame, emb: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """J7 for building an index: the embeddings, or ValueError if ids and
    vectors differ in number, keys or dimension."""
    report = validate_embeddings(ids, emb, key, vec).first()
    if not report["valid"]:
        raise ValueError(f"ids and embeddings do not match: {report.asDict()}")
    return emb


def centroids(df: DataFrame, group: str, vec: str = "embedding", out: str = "vector") -> DataFrame:
    """Mean vector per group (per-dimension average, partial-aggregated)."""
    per_dim = (
        df.select(group, F.posexplode(vec).alias("_i", "_x"))
        .groupBy(group, "_i")
        .agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    )
    return per_dim.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias(out)
    )


# ---------------------------------------------------------------------------
# V4 / L4: exact top-k
# ---------------------------------------------------------------------------


# Upper bound on the score-matrix entries one Python worker holds at a time
# (4M doubles = 32 MB); item batches are scored in chunks under it.
SCORE_CELLS = 4_000_000


class _BestK:
    """Running best k items per query, by (rounded score descending, id)."""

    def __init__(self, qids, qmat, k, normalize, min_score):
        self.qids, self.qmat, self.k, self.normalize, self.min_score = qids, qmat, k, normalize, min_score
        self.qnorm = np.sqrt(np.einsum("ij,ij->i", qmat, qmat)) if len(qids) else np.zeros(0)
        self.best: list[list[tuple]] = [[] for _ in qids]
        self.floor = np.full(len(qids), -np.inf)  # score of the k-th item so far

    def add(self, ids, emat) -> None:
        """Score items in chunks of at most ``SCORE_CELLS`` entries."""
        step = max(1, SCORE_CELLS // max(1, len(self.qids)))
        for i in range(0, emat.shape[0], step):
            self._add_chunk(ids[i:i + step], emat[i:i + step])

    def _add_chunk(self, ids, emat) -> None:
        scores = emat @ self.qmat.T
        if self.normalize:
            enorm = np.sqrt(np.einsum("ij,ij->i", emat, emat))
            denom = enorm[:, None] * self.qnorm[None, :]
            scores = np.divide(scores, denom, out=np.zeros_like(scores), where=denom > 0)
        scores = np.round(scores, SCORE_DIGITS)
        keep = scores >= self.floor[None, :]
        if self.min_score is not None:
            keep &= scores > self.min_score
        if scores.shape[0] > self.k:
            keep &= scores >= -np.partition(-scores, self.k - 1, axis=0)[self.k - 1][None, :]
        for q in np.flatnonzero(keep.any(axis=0)):
            rows = np.flatnonzero(keep[:, q])
            new = ((-scores[r, q], ids[r] is not None, ids[r]) for r in rows)
            self.best[q] = heapq.nsmallest(self.k, (*self.best[q], *new))
            if len(self.best[q]) == self.k:
                self.floor[q] = -self.best[q][-1][0]

    def rows(self):
        """Query ids, item ids and scores: at most k rows per query."""
        flat = [(self.qids[q], e[2], -e[0]) for q, found in enumerate(self.best) for e in found]
        return [r[0] for r in flat], [r[1] for r in flat], [float(r[2]) for r in flat]


def _stack(series: pd.Series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series])


def top_k_similar(
    queries: DataFrame,
    items: DataFrame,
    k: int = DEFAULT_TOP_K,
    query_id: str = "qid",
    query_vec: str = "vector",
    item_id: str = "id",
    item_vec: str = "vector",
    normalize: bool = True,
    min_score: float | None = None,
    max_broadcast_queries: int = 2048,
    max_broadcast_bytes: int = 64 << 20,
    query_block_bytes: int = 256 << 20,
    item_block_bytes: int = 128 << 20,
    item_buckets: int | None = None,
) -> DataFrame:
    """V4 + L4: for each query, the k items with the highest inner product
    (cosine when ``normalize``), ranked by (rounded score desc, item id).

    Output: ``query_id, item_id, score, rank``.  Fewer than k rows for a query
    is not an error.  ``min_score`` drops items scoring at or below it (e.g.
    0 for the sparse encoding, where no shared bucket means no match).

    The broadcast path needs at most ``max_broadcast_queries`` queries and
    ``max_broadcast_bytes`` of query vectors.  Beyond that the blocked path sizes its blocks by
    bytes: query blocks up to ``query_block_bytes`` (few, large blocks keep the
    number of item copies low) and item blocks up to ``item_block_bytes`` (so
    one co-group always fits in a Python worker).  The queries are written
    once and measured there before any of them reaches the driver.

    With ``item_buckets`` the item column holds bucket ids
    (:func:`term_buckets`) that are counted in the scoring task.
    """
    k = max(1, k)
    spark = items.sparkSession
    q_type = queries.schema[query_id].dataType.simpleString()
    i_type = items.schema[item_id].dataType.simpleString()
    out_schema = f"{query_id} {q_type}, {item_id} {i_type}, score double"
    items_slim = items.select(item_id, item_vec)

    matrix = _stack if item_buckets is None else (lambda column: bucket_counts(column, item_buckets))
    queries = reliable_checkpoint(queries.select(query_id, query_vec), "top-k-queries")
    n_q, dim = queries.agg(F.count(F.lit(1)), F.max(F.size(query_vec))).first()
    dim = max(1, dim or 1)
    if n_q <= max_broadcast_queries and n_q * dim * 8 <= max_broadcast_bytes:
        rows = queries.collect()  # within the bounds just checked
        qids = np.array([r[0] for r in rows], dtype=object)
        qmat = _stack(pd.Series([r[1] for r in rows])) if rows else np.zeros((0, 0))
        block = spark.sparkContext.broadcast((qids, qmat))

        def scan(batches):
            b_qids, b_qmat = block.value
            best = _BestK(b_qids, b_qmat, k, normalize, min_score)
            for pdf in batches:
                if len(pdf) and len(b_qids):
                    best.add(pdf[item_id].to_numpy(dtype=object), matrix(pdf[item_vec]))
            q, i, s = best.rows()
            if q:
                yield pd.DataFrame({query_id: q, item_id: i, "score": s})

        candidates = items_slim.mapInPandas(scan, out_schema)
    else:
        candidates = _blocked_candidates(
            queries, items_slim, k, query_id, query_vec, item_id, item_vec, matrix,
            normalize, min_score, max(1, query_block_bytes // (8 * dim)), max(1, item_block_bytes // (8 * dim)),
            out_schema, n_q,
        )

    rounded = candidates.withColumn("score", F.round("score", SCORE_DIGITS))
    if min_score is not None:
        rounded = rounded.where(F.col("score") > min_score)
    w = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(item_id))
    return rounded.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _blocked_candidates(
    queries, items, k, query_id, query_vec, item_id, item_vec, matrix, normalize, min_score, q_block_rows,
    item_block_rows, out_schema, n_q,
):
    n_i = items.count()
    qb = max(1, math.ceil(n_q / q_block_rows))
    ib = max(1, math.ceil(n_i / item_block_rows))
    # Each query row is copied to every item block and each item row to every
    # query block: qb*n_i + ib*n_q rows move, every cell is bounded.
    q_cells = queries.withColumn("_qb", F.pmod(F.xxhash64(query_id), F.lit(qb))).withColumn(
        "_ib", F.explode(F.sequence(F.lit(0), F.lit(ib - 1)))
    )
    i_cells = items.withColumn("_ib", F.pmod(F.xxhash64(item_id), F.lit(ib))).withColumn(
        "_qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))
    )

    def cell(qpdf: pd.DataFrame, ipdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(ipdf) == 0:
            return pd.DataFrame({query_id: [], item_id: [], "score": []})
        best = _BestK(qpdf[query_id].to_numpy(dtype=object), _stack(qpdf[query_vec]), k, normalize, min_score)
        best.add(ipdf[item_id].to_numpy(dtype=object), matrix(ipdf[item_vec]))
        q, i, s = best.rows()
        return pd.DataFrame({query_id: q, item_id: i, "score": s})

    return (
        q_cells.groupBy("_qb", "_ib")
        .cogroup(i_cells.groupBy("_qb", "_ib"))
        .applyInPandas(cell, out_schema)
    )
