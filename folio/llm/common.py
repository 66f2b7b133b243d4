"""Stage tables and Arrow helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.session import delete_path, scratch_path
from folio.sources.tables import read_table


#: Most bytes of an Arrow batch that a Python worker is sent.
BATCH_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


class Stages:
    """Parquet stage tables of one operator run, in the shared checkpoint folder.

    ``put`` writes a frame and returns the table read back: lineage ends there
    and the rows survive lost executors.  ``drop`` deletes tables that nothing
    reads any more; tables that the result reads stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, self.paths.pop(name))


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast hint for a side whose counted ``rows`` stay within ``limit``;
    a larger side is left to the shuffle join."""
    return F.broadcast(df) if rows <= limit else df


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0 (false for a missing id)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(col.cast("string")), F.lit(5)) == 0, F.lit(False))


def slices(batch: pa.RecordBatch | pa.Array, most: int = 8 << 20) -> Iterator:
    """Zero-copy row ranges of a batch (or array) of about ``most`` bytes."""
    rows = len(batch) if isinstance(batch, pa.Array) else batch.num_rows
    step = max(1, rows // max(1, -(-batch.nbytes // most)))
    for i in range(0, rows, step):
        yield batch.slice(i, step)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold ``BATCH_BYTES`` at most.  With
    Spark's default of 64 MB, whole texts would take several times that, in
    the JVM and in the Python worker, for every running task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def release_memory() -> None:
    """Give freed Arrow and heap memory back to the system: Python workers
    live on between tasks and would keep their largest task's memory."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def map_text(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with a function of one batch of a few MB, so no
    partition is ever held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield from fn(part)
        release_memory()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_column(spark: SparkSession, fn: Callable[[pa.Array], pa.Array], kind: str, column: Column) -> Column:
    """Arrow UDF of one column, applied to a few MB at a time."""
    small_batches(spark)

    @F.arrow_udf(kind)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.concat_arrays([fn(x) for x in slices(part)]) if len(part) else fn(part)
        release_memory()

    return run(column)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, concatenated, and the offsets of its
    rows (null: empty)."""
    arr = arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr
    arr = arr.cast(pa.large_binary()) if arr.null_count == 0 else arr.fill_null("").cast(pa.large_binary())
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def row_chunks(offs: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together (a longer row alone)."""
    first = 0
    for i in range(1, len(offs)):
        if offs[i] - offs[first] > most and i - 1 > first:
            yield first, i - 1
            first = i - 1
    if len(offs) > 1:
        yield first, len(offs) - 1


def binary_list(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def grouped_stream(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Rows of one key after another from batches sorted by key; only one
    (bounded) group is held at a time."""
    held: dict[str, list] | None = None
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        for i, key in enumerate(zip(*(cols[k] for k in keys))):
            if key != at:
                if held is not None:
                    yield held
                held, at = {n: [] for n in cols}, key
            for n, vals in cols.items():
                held[n].append(vals[i])
    if held is not None:
        yield held
