"""Alignment by digests (J7, V6): only key ranges that differ are joined.

:func:`folio.operators.vectors.validate_embeddings` joins all ids with all
vectors.  Most of the time nearly everything matches.  Here both sides are first
reduced, without a shuffle of rows, to one small row per *range* of keys (a
range is a value of a hash of the key): the number of rows and two sums of
64-bit hashes of their keys.  Sums do not depend on order and repeated rows add
to them, so equal digests mean equal keys, each as often (two different sets of
keys agree in both sums by chance once in some 2^128).  Rows of ranges with
equal digests match by that alone; the rows of the other ranges go through the
exact join.

The digests are a few dozen bytes per range whatever the table's size, and may
be kept: :func:`key_digests` of a table that did not change need not be taken
again.

Defined results: those of ``validate_embeddings``.  NULL keys match nothing and
form a range of their own that always differs; empty tables have no ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.vectors import align_embeddings
from folio.session import reliable_checkpoint

#: Ranges of keys.  One row each per digest table, so a table of ranges may be broadcast.
RANGES = 4096
#: The range of NULL keys.
NO_KEY = -1


def range_of(key: str, ranges: int) -> Column:
    return F.when(F.col(key).isNull(), NO_KEY).otherwise(F.pmod(F.xxhash64(F.lit("range"), key), F.lit(ranges)).cast("int"))


def key_digests(rows: DataFrame, key: str, *by: Column, ranges: int = RANGES) -> DataFrame:
    """``range`` (and ``by``), ``n`` and the sums ``s1`` and ``s2`` of the rows in it."""
    return rows.groupBy(range_of(key, ranges).alias("range"), *by).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(F.xxhash64(F.lit(s), key).cast("decimal(38,0)")).alias(s) for s in ("s1", "s2")))


def differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """``range`` of the ranges that two digest tables do not agree on, and that of NULL keys."""
    sides = [d.groupBy("range").agg(F.struct(F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2")).alias(name))
             for d, name in ((one, "a"), (other, "b"))]
    both = sides[0].join(sides[1], "range", "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b")) | (F.col("range") == NO_KEY)).select("range")


def in_ranges(rows: DataFrame, key: str, wanted: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The rows whose key lies in one of the ``wanted`` ranges (at most ``ranges`` + 1 rows, broadcast)."""
    few = F.broadcast(wanted.select(F.col("range").alias("_range")))
    return rows.join(few, range_of(key, ranges) == F.col("_range"), "left_semi")


def validate_by_digests(ids: DataFrame, emb: DataFrame, key: str, vec: str = "embedding", ranges: int = RANGES) -> DataFrame:
    """V6: the report of ``validate_embeddings``, and ``n_ranges_joined``."""
    left = reliable_checkpoint(key_digests(ids, key, ranges=ranges), "id-digests")
    right = reliable_checkpoint(key_digests(emb, key, F.size(vec).alias("dimension"), ranges=ranges), "vector-digests")
    differ = reliable_checkpoint(differing(left, right), "differing-ranges")
    aligned = align_embeddings(in_ranges(ids.select(key), key, differ, ranges), in_ranges(emb.select(key, vec), key, differ, ranges), key, vec)
    joined = aligned.agg(
        F.count_if(F.col("has_id") & F.col("has_vector")).alias("n_joined"),
        F.count_if(F.col("has_id") & ~F.col("has_vector")).alias("n_ids_without_vector"),
        F.count_if(~F.col("has_id") & F.col("has_vector")).alias("n_vectors_without_id"),
    )
    same = right.join(F.broadcast(differ), "range", "left_anti")
    count = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return joined.select(
        left.agg(count).scalar().alias("n_ids"),
        right.agg(count).scalar().alias("n_vectors"),
        (F.col("n_joined") + same.agg(count).scalar()).alias("n_matched"),
        "n_ids_without_vector",
        "n_vectors_without_id",
        right.agg(F.count_distinct("dimension").cast("bigint")).scalar().alias("n_dimensions"),
        differ.agg(F.count(F.lit(1))).scalar().alias("n_ranges_joined"),
    ).withColumn(
        "valid",
        (F.col("n_ids") == F.col("n_vectors")) & (F.col("n_ids_without_vector") == 0)
        & (F.col("n_vectors_without_id") == 0) & (F.col("n_dimensions") <= 1),
    )
