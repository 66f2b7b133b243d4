"""Incremental enrichment with the finished keys in streaming state.

The same result as :func:`folio.streaming.incremental.enrich_stream`, but a
micro-batch does not read the output table: whether a key is finished is asked
of the stream's state store, so a batch costs what its own rows cost, however
large the output has grown.

* The state is that of a streaming ``dropDuplicates`` over the keys alone: one
  entry per key, no record.  Before its shuffle every task sends a key once per
  Arrow batch, however many rows hold it.  The state lives in RocksDB (off
  heap, spilled to disk) with its files in the checkpoint, and is restored
  after a failure.
* A micro-batch holds its rows, the keys it has seen for the first time and the
  seeds (below).  It is written once; the first row by position of every new
  key is then taken from it by joins and aggregates, which spill and are
  planned for the batch's own size.  No code runs per key.
* The accepted rows are enriched and written as one folder per micro-batch.
  A batch that is run again after a failure replaces its own folder, so no
  row is stored twice.
* A new checkpoint over an output that has rows already (a lost checkpoint, a
  moved job) starts with the keys of that output as its state: they are read
  once, when the job is started, not per batch.

Rows without a key never conflict and all pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folio.functions import book_key
from folio.operators.cleaning import keep_first
from folio.operators.enrichment import MetadataLookup, build_lookup, enrich
from folio.operators.store import read_store
from folio.session import delete_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: What a row of a micro-batch is: a record, a key seen for the first time, or
#: a key that counts as seen.
RECORD, FRESH, SEED = "record", "fresh", "seed"


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.drop_duplicates()


def marked(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """kind, state_key and record of everything that a micro-batch needs.
    ``rows`` and ``seeds`` are streams; ``seeds`` has keys that count as seen.
    The state says which keys no earlier batch had."""
    def kind(df: DataFrame, name: str, record=F.lit(None)) -> DataFrame:
        return df.select(F.lit(name).alias("kind"), "state_key", record.cast(rows.schema).alias("record"))

    records = rows.select(book_key().alias("state_key"), F.struct(*rows.columns).alias("record"))
    keys = rows.select(book_key().alias("state_key")).where(F.col("state_key").isNotNull())
    seen = seeds.select(F.col("book_key").alias("state_key"))
    new = keys.mapInPandas(_distinct, keys.schema).unionByName(seen).dropDuplicates(["state_key"])
    return kind(records, RECORD, F.col("record")).unionByName(kind(new, FRESH)).unionByName(kind(seen, SEED))


def new_records(batch: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row of every key of a written micro-batch (see :func:`marked`)
    that no earlier batch had and that is no seed; all rows without a key.
    Rows at equal positions go by their JSON."""
    def keys(name: str) -> DataFrame:
        return batch.where(F.col("kind") == name).select("state_key")

    rows = batch.where(F.col("kind") == RECORD).select("state_key", "record")
    text = F.to_json("record", {"ignoreNullFields": "false"})
    position = [F.col("record")[c] for c in order]
    first = keep_first(rows.where(F.col("state_key").isNotNull()), ["state_key"], [*position, text])
    fresh = keys(FRESH).join(keys(SEED), "state_key", "left_anti")
    keyless = rows.where(F.col("state_key").isNull())
    return first.join(fresh, "state_key", "left_semi").unionByName(keyless).select("record.*")


def _write_seeds(spark: SparkSession, out_dir: str, path: str) -> None:
    """The keys that the output has at the start, for a new checkpoint."""
    done = read_store(spark, out_dir)
    if done is None:
        keys = spark.createDataFrame([], "book_key string")
    else:
        keys = done.select("book_key").where(F.col("book_key").isNotNull()).distinct()
    keys.write.parquet(f"{path}/keys")
    # The name of this checkpoint's batches; last, so that it marks the end.
    spark.createDataFrame([(uuid.uuid4().hex,)], "run string").coalesce(1).write.parquet(f"{path}/run")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def enrich_stream_keyed(
    spark: SparkSession,
    source_dir: str,
    source_schema: StructType,
    meta: DataFrame | MetadataLookup,
    out_dir: str,
    checkpoint: str,
    files_per_batch: int | None = 1,
    order: Sequence[str] = ("row_pos",),
    processing_time: str | None = None,
):
    """Run the incremental job; arguments and result as for
    :func:`folio.streaming.incremental.enrich_stream`.  The output is read
    with :func:`read_output`."""
    order = list(order)
    batches = {"n": 0}
    lookup = meta if isinstance(meta, MetadataLookup) else build_lookup(meta).materialize()
    # Folders of their own: the state of an earlier form of this job, one flag
    # per key and group, can't be read as that of dropDuplicates.
    seeds = f"{checkpoint}/known"
    if not _exists(spark, f"{seeds}/run/_SUCCESS"):
        if _exists(spark, seeds):
            delete_path(spark, seeds)  # left by a start that failed
        _write_seeds(spark, out_dir, seeds)
    run = spark.read.parquet(f"{seeds}/run").first()["run"]

    def process(batch: DataFrame, epoch_id: int) -> None:
        # Once, as the state is written along; a batch run again replaces it.
        written = f"{checkpoint}/batches/{epoch_id}"
        batch.write.mode("overwrite").parquet(written)
        done = enrich(new_records(spark.read.parquet(written), order), lookup, carry=tuple(order))
        done.write.mode("overwrite").parquet(f"{out_dir}/batch={run}-{epoch_id}")
        delete_path(spark, written)
        batches["n"] += 1

    reader = spark.readStream.schema(source_schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The seeds are one source of their own, whole in the first batch.
    known = spark.readStream.schema("book_key string").parquet(f"{seeds}/keys")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        writer = (marked(reader.parquet(source_dir), known).writeStream.foreachBatch(process).outputMode("append")
                  .option("checkpointLocation", f"{checkpoint}/keys"))
        if processing_time is not None:
            return writer.trigger(processingTime=processing_time).start()
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return batches["n"]


def read_output(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The rows stored so far, without the name of their batch."""
    out = read_store(spark, out_dir)
    return None if out is None else out.drop("batch")
