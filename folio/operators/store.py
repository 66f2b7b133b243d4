"""Keyed book store with insert-or-ignore semantics.

The store is a Parquet table.  Uniqueness of ``book_key`` is enforced by the
write job instead of an index:

1. D4 keeps the first incoming row per key (rows with a NULL key never
   conflict and all pass), skew-safe via partial top-1 per task;
2. J4 drops incoming keys that already exist, reading only the key column of
   the stored table (left anti-join; broadcast when the measured key set is
   small, sort-merge otherwise);
3. the survivors are appended as new files through Spark's commit protocol,
   so a failed or retried job never leaves a partial append visible.

Re-running the same input appends nothing, which makes replays idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.constants import ENRICHED_COLUMNS, LIST_COLUMNS
from folio.functions import integer_affinity, lists_to_json
from folio.operators.cleaning import keep_first


def to_store_rows(enriched: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Enriched records -> stored row shape.

    Lists become compact JSON text (P14; a NULL list stays NULL), ``pages``
    keeps its text and gains an integer column (P19).
    """
    cols: list[Column | str] = [*keep]
    for c in ENRICHED_COLUMNS:
        if c in LIST_COLUMNS:
            cols.append(lists_to_json(c).alias(c))
        elif c == "pages":
            cols.append(F.col(c).cast("string").alias(c))
        else:
            cols.append(F.col(c))
    return enriched.select(*cols).withColumn("pages_int", integer_affinity("pages"))


def insert_or_ignore(
    incoming: DataFrame,
    existing: DataFrame | None,
    key: str = "book_key",
    order: Sequence[str | Column] = ("row_pos",),
) -> DataFrame:
    """Rows of ``incoming`` that the store would accept (D4 then J4)."""
    first = keep_first(incoming, [key], order, null_keys="keep")
    if existing is None:
        return first
    keys = existing.select(key).where(F.col(key).isNotNull())
    return first.join(keys, on=key, how="left_anti")


def append_to_store(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    key: str = "book_key",
    order: Sequence[str | Column] = ("row_pos",),
    cluster_by_key: bool = False,
) -> DataFrame:
    """Append the accepted rows to the Parquet table at ``path``.

    An empty input is an error (as in the reference loader).  Returns the
    stored table as read back after the commit.

    ``cluster_by_key=True`` range-partitions and sorts the appended rows on
    ``key``, so every new file covers a narrow key range and Parquet min/max
    statistics let point lookups (``key = ...``, pushed into the scan) skip
    most files and row groups; it costs one range shuffle of the new rows.
    """
    if incoming.isEmpty():
        raise ValueError("insert_or_ignore: input is empty")
    existing = read_store(spark, path)
    accepted = insert_or_ignore(incoming, existing, key, order)
    if cluster_by_key:
        accepted = accepted.repartitionByRange(key).sortWithinPartitions(key)
    accepted.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """Scan the stored table, or None when it does not exist yet."""
    try:
        return spark.read.parquet(path)
    except Exception as exc:  # missing path
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc).lower():
            return None
        raise
