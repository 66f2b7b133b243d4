"""Sinks and dataset readers: per-source output, stage tables, enriched
records, flat exports, features and embeddings (S5, S7-S11, S14).

All writes go through Spark's output committer: a job either commits all of
its files or none, and a retried task never leaves partial output visible.
Nothing is ever overwritten while it is being read: versioned outputs get a
new directory per write.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from folio.constants import ENRICHED_COLUMNS, LIST_COLUMNS
from folio.operators.features import features, join_lists

CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

ENRICHED_SCHEMA = StructType(
    [
        StructField(c, ArrayType(StringType()) if c in LIST_COLUMNS else StringType())
        for c in ENRICHED_COLUMNS
    ]
)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """CSV with a header, RFC-4180 quoting and whitespace preserved."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).option("encoding", encoding).csv(path)


def write_per_source(df: DataFrame, path: str, source_col: str = "source_file", fmt: str = "csv") -> None:
    """One output directory per input file (``<source_col>=<name>``).

    No shuffle precedes the write: every task writes its own rows of each
    source, so a source holding a large share of the rows is still written
    by all tasks in parallel (at the cost of one file per task and source).
    """
    writer = df.write.mode("overwrite").partitionBy(source_col)
    if fmt == "csv":
        writer.options(**CSV_WRITE_OPTIONS).csv(path)
    else:
        writer.format(fmt).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a stage table (Parquet by default, CSV optional)."""
    if fmt == "csv":
        write_csv(df, path, mode)
    else:
        df.write.mode(mode).format(fmt).save(path)


def read_enriched(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Enriched records with a fixed schema.

    ``fmt='json'`` reads JSON Lines (splittable); ``'json_array'`` reads one
    JSON array per file (not splittable: one task per file); ``'parquet'``
    reads the columnar form.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.schema(ENRICHED_SCHEMA)
    if fmt == "json_array":
        reader = reader.option("multiLine", True)
    return reader.json(path)


_VERSION = re.compile(r"/version=(\d+)/_SUCCESS$")


def latest_version(spark: SparkSession, base: str) -> int | None:
    """Highest committed version number under ``base``: only version folders
    whose write ended (``_SUCCESS``) count, and only those marks are listed."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    versions = [int(m.group(1)) for f in found or [] if (m := _VERSION.search(f.getPath().toString()))]
    return max(versions) if versions else None


def save_enriched(spark: SparkSession, df: DataFrame, base: str, fmt: str = "json") -> str:
    """Write a new version directory; readers of older versions are never
    disturbed and a failed write leaves the previous version as the latest
    (its own folder, which has no ``_SUCCESS``, is written over)."""
    current = latest_version(spark, base)
    target = f"{base.rstrip('/')}/version={0 if current is None else current + 1}"
    df.write.mode("overwrite").format(fmt).save(target)
    return target


def read_latest(spark: SparkSession, base: str, fmt: str = "json") -> DataFrame | None:
    """The newest committed version of an enriched dataset (S8 on S9's output)."""
    v = latest_version(spark, base)
    if v is None:
        return None
    return read_enriched(spark, f"{base.rstrip('/')}/version={v}", fmt)


def export_flat(df: DataFrame, path: str) -> None:
    """Flat CSV snapshot (list columns joined with ', ')."""
    write_csv(join_lists(df), path)


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The frozen feature table."""
    write_table(features(df), path, fmt)


EMBEDDING_SCHEMA = StructType(
    [StructField("record_id", StringType()), StructField("embedding", ArrayType(FloatType()))]
)


def write_embeddings(df: DataFrame, path: str, id_col: str = "record_id", vec: str = "embedding") -> None:
    """(id, float vector) Parquet; ids travel with their vectors.

    The id is stored as text (the fixed read schema), so numeric ids round-trip too.
    """
    df.select(F.col(id_col).cast("string").alias("record_id"), F.col(vec).cast(ArrayType(FloatType())).alias("embedding")).write.mode(
        "overwrite"
    ).parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EMBEDDING_SCHEMA).parquet(path)


def read_flat(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a flat CSV snapshot written by :func:`export_flat` / :func:`write_csv`
    (or a per-source directory from :func:`write_per_source`).  ``schema``
    fixes the column types instead of reading everything as text; it may name
    the per-source partition column."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return (
        reader.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
