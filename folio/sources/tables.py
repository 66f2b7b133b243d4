"""Readers for the parquet tables the jobs run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Scan one parquet table; Catalyst prunes columns and pushes filters.

    ``spread=True`` is for scans feeding CPU-heavy per-row work (tokenising,
    hashing, encoding whole texts): see :func:`spread_scan`.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    return spread_scan(df) if spread else df


def spread_scan(df: DataFrame) -> DataFrame:
    """Round-robin a scan over all task slots when it has fewer partitions.

    A small table stored as one Parquet row group is read by a single task,
    which then does all of the per-row CPU work alone.  When the scan yields
    fewer partitions than the session has task slots, the rows are
    redistributed (only the columns the query keeps are shuffled, and the
    input is by construction smaller than one wave of splits).  A large input
    already has at least one split per slot, so this is a no-op at scale.
    Call it on a bare scan only: counting partitions of a plan with shuffles
    would execute it.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
