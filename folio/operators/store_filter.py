"""A key filter beside the book store (S12, J4 at scale).

``append_filtered`` gives the table that ``append_to_store`` gives, but does
not read the key column of the whole store on every append.  Each stored file
has a Bloom filter of its keys, made of built-in aggregates:

* a key sets ``BITS`` bits within one block of 256 bits (four longs), so a key
  is asked of a filter by one join on the block number;
* a file's filter has a power of two of blocks, at ``KEYS_PER_BLOCK`` keys a
  block; filters of one size are merged by ``bit_or`` (:func:`merged`);
* incoming keys are joined with the filters' blocks.  Keys that no filter may
  hold are new without reading anything.  The rest are decided exactly, by an
  anti-join with the key column of only those files that may hold one.

Filters are kept in a table beside the store.  A file without a filter (an
append that failed before its filter was written, files from elsewhere) is
always read, and gets its filter with the next append.  So the result is exact
whatever the filters say; they only save reads.  At 32 bits a key a filter errs
for about one key in 100,000: a delivery of new keys reads nothing, one of a
few old ones the files that hold them, and only one of millions of keys comes
near to reading all, as the plain append always does.  Rows without a key never
conflict and all pass.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.cleaning import keep_first
from folio.operators.store import read_store
from folio.session import reliable_checkpoint

BITS, WORDS, KEYS_PER_BLOCK = 8, 4, 8
#: More file names than this are left to a join instead of a list in the scan.
MOST_LISTED = 10_000


#: One spelling of a file's name: listings write ``file:///a``, scans ``file:/a``.
SLASHES = r"^([A-Za-z0-9+.-]+):/+(?=/)"


def _listed(df: DataFrame | None) -> set[str]:
    return {re.sub(SLASHES, r"\1:", f) for f in df.inputFiles()} if df is not None else set()


def filters_path(path: str) -> str:
    return path.rstrip("/") + ".filters"


def _masks(key: Column) -> list[Column]:
    """The four longs of a key's bits: ``BITS`` positions of a block, from
    slices of a second hash."""
    h = F.xxhash64(F.lit(BITS), key)
    places = [F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(255)) for i in range(BITS)]
    out = []
    for w in range(WORDS):
        word = F.lit(0).cast("long")
        for p in places:
            here = F.shiftrightunsigned(p, 6) == w
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
            word = word.bitwiseOR(F.when(here, bit).otherwise(F.lit(0).cast("long")))
        out.append(word)
    return out


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def build_filters(keys: DataFrame, key: str, file: str) -> DataFrame:
    """file, blocks, block, w0..w3: one row per used block of every file.
    The partial aggregate leaves a task one row per block."""
    # A repeated key counts twice here, which only makes a filter larger.
    counted = keys.where(F.col(key).isNotNull()).groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    need = F.greatest(F.lit(1.0), F.col("n") / KEYS_PER_BLOCK)
    sizes = counted.select(file, F.pow(F.lit(2.0), F.ceil(F.log2(need))).cast("long").alias("blocks"))
    rows = keys.where(F.col(key).isNotNull()).join(F.broadcast(sizes), file)  # a row per file
    words = [m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))]
    return rows.select(file, "blocks", _block(F.col(key), F.col("blocks")).alias("block"), *words).groupBy(file, "blocks", "block").agg(
        *(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def merged(filters: DataFrame) -> DataFrame:
    """Filters of one size as one: the keys of all their files."""
    return filters.groupBy("blocks", "block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def may_hold(keys: DataFrame, key: str, filters: DataFrame) -> DataFrame:
    """key and file of every (distinct, non-null) key and file whose filter
    has all bits of the key.  Keys are copied once per filter size (a power of
    two, so a few), not per file."""
    sizes = filters.select("blocks").distinct()
    asked = keys.select(key, *(m.alias(f"m{i}") for i, m in enumerate(_masks(F.col(key))))).crossJoin(F.broadcast(sizes))  # some 40 sizes at most
    asked = asked.withColumn("block", _block(F.col(key), F.col("blocks")))
    all_bits = F.lit(True)
    for i in range(WORDS):
        all_bits = all_bits & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    return asked.join(filters, ["blocks", "block"]).where(all_bits).select(key, "file")


def _update_filters(spark: SparkSession, path: str, key: str) -> None:
    """Filters for the stored files that have none yet."""
    store = read_store(spark, path)
    if store is None:
        return
    fresh = _without_filter(spark, path)
    if fresh:
        keys = spark.read.schema(store.schema).parquet(*fresh).select(key, F.regexp_replace(F.col("_metadata.file_path"), SLASHES, "$1:").alias("file"))
        build_filters(keys, key, "file").write.mode("append").parquet(filters_path(path))


def _without_filter(spark: SparkSession, path: str) -> list[str]:
    """Names of the stored files (the driver lists them for any scan) that no
    filter covers."""
    store, filters = read_store(spark, path), read_store(spark, filters_path(path))
    files = spark.createDataFrame([(f,) for f in _listed(store)], "file string")
    if filters is not None:
        files = files.join(filters.select("file").distinct(), "file", "left_anti")
    return [r["file"] for r in files.collect()]


def insert_filtered(spark: SparkSession, incoming: DataFrame, path: str, key: str = "book_key",
                    order: Sequence[str | Column] = ("row_pos",), read: list[str] | None = None) -> DataFrame:
    """The rows of ``incoming`` that the store at ``path`` would accept.
    ``read`` takes the names of the files whose keys were read."""
    first = keep_first(incoming, [key], order, null_keys="keep")
    store, filters = read_store(spark, path), read_store(spark, filters_path(path))
    if store is None:
        return first
    first = reliable_checkpoint(first, "incoming")
    keys = first.select(key).where(F.col(key).isNotNull())
    files = set(_without_filter(spark, path))
    if filters is not None:
        # Old names of files that are gone say nothing.
        files |= {r["file"] for r in may_hold(keys, key, filters).select("file").distinct().collect()} & _listed(store)
    if read is not None:
        read.extend(sorted(files))
    if not files:
        return first
    if len(files) <= MOST_LISTED:
        stored = spark.read.schema(store.schema).parquet(*sorted(files))
    else:
        stored = store
    return first.join(stored.select(key).where(F.col(key).isNotNull()), on=key, how="left_anti").select(*first.columns)


def append_filtered(spark: SparkSession, incoming: DataFrame, path: str, key: str = "book_key",
                    order: Sequence[str | Column] = ("row_pos",), cluster_by_key: bool = True, read: list[str] | None = None) -> DataFrame:
    """S12 with the key filter: append the accepted rows, then the filters of
    the new files.  Returns the stored table."""
    if incoming.isEmpty():
        raise ValueError("insert_or_ignore: input is empty")
    accepted = insert_filtered(spark, incoming, path, key, order, read)
    if cluster_by_key:
        accepted = accepted.repartitionByRange(key).sortWithinPartitions(key)
    accepted.write.mode("append").parquet(path)
    _update_filters(spark, path, key)
    return spark.read.parquet(path)
