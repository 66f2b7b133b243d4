"""Raw catalogue CSV source (S1-S4, S6) and the ingest job.

A directory of catalogue CSVs may mix files with different headers (other
column order, missing or extra columns).  One ``spark.read.csv`` over such a
directory would apply one header to every file by position, so files are
grouped by header first:

1. the file list comes from Spark's own file index (``inputFiles()`` on a
   ``binaryFile`` scan that never reads content);
2. a small Spark job reads the first CSV record of every file (the header) in
   parallel on the executors;
3. each distinct header gets one ``spark.read.csv`` over its files with a
   positional all-string schema, renamed to that header;
4. the groups are unioned by column name, missing columns as NULL.

Every row carries ``source_file``, ``file_path``, ``file_block_start`` and
``row_pos`` (``monotonically_increasing_id`` taken in the scan, before any
shuffle), so "first row" later means (file_path, file_block_start, row_pos):
file order, then row order inside the file.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from folio.constants import CANONICAL_COLUMNS, COLUMN_MAPPING, NA_TOKENS
from folio.functions import coerce_numeric, null_tokens, stringify

ORDER_COLUMNS = ("file_path", "file_block_start", "row_pos")
SOURCE_COLUMNS = ("source_file", "file_path", "file_block_start", "row_pos")
CSV_ENCODING = "ISO-8859-1"


def list_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> list[str]:
    """Files under ``path`` matching ``pattern``; missing directory = error."""
    try:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc).lower():
            raise FileNotFoundError(f"no such folder of CSV files: {path}") from exc
        raise
    return sorted(listing.inputFiles())


def first_record(chunks: Iterable[bytes], encoding: str) -> list[str]:
    """The first CSV record of a file, however long and over however many
    lines: bytes are read until a line break outside quotes (or the end)."""
    name = "latin-1" if encoding.upper() in ("ISO-8859-1", "LATIN1") else encoding
    decoder = codecs.getincrementaldecoder(name)(errors="replace")
    text, quoted, at = "", False, 0
    for chunk in chunks:
        text += decoder.decode(chunk)
        while at < len(text):
            if text[at] == '"':
                quoted = not quoted
            elif text[at] in "\r\n" and not quoted:
                return next(csv.reader(io.StringIO(text[:at], newline="")), [])
            at += 1
    return next(csv.reader(io.StringIO(text, newline="")), [])


def _read_header(uri: str, encoding: str) -> list[str]:
    from pyarrow import fs as pafs

    filesystem, p = pafs.FileSystem.from_uri(uri)
    with filesystem.open_input_stream(p) as f:
        return first_record(iter(lambda: f.read(1 << 16), b""), encoding)


#: What Arrow says of a file system it has no reader for.
NO_ARROW_READER = re.compile("Unrecognized filesystem|Protocol not known|libhdfs|libjvm|not built with support", re.IGNORECASE)


def sniff_headers(spark: SparkSession, files: Sequence[str], encoding: str = CSV_ENCODING) -> dict[tuple, list[str]]:
    """Distinct header -> files having it.  Headers are read on the executors,
    by Arrow's file systems, or by Spark's where Arrow has none; the same
    parser takes the first record either way."""
    if not files:
        return {}
    paths = spark.createDataFrame([(f,) for f in files], "path string")
    n = max(1, min(len(files), spark.sparkContext.defaultParallelism * 4))

    def read(batches):
        for pdf in batches:
            yield pd.DataFrame(
                {"path": pdf["path"], "header": [json.dumps(_read_header(u, encoding)) for u in pdf["path"]]}
            )

    def read_content(batches):
        for pdf in batches:
            yield pd.DataFrame(
                {"path": pdf["path"], "header": [json.dumps(first_record([bytes(c)], encoding)) for c in pdf["content"]]}
            )

    try:
        pairs = paths.repartition(n).mapInPandas(read, "path string, header string").collect()
    except PythonException as exc:
        if not NO_ARROW_READER.search(str(exc)):
            raise
        whole = spark.read.format("binaryFile").load(list(files)).select("path", "content")
        pairs = whole.mapInPandas(read_content, "path string, header string").collect()
    given = {unquote(urlparse(f).path): f for f in files}  # same file, other URI spelling
    groups: dict[tuple, list[str]] = {}
    for r in sorted(pairs, key=lambda r: r["path"]):
        groups.setdefault(tuple(json.loads(r["header"])), []).append(given.get(unquote(urlparse(r["path"]).path), r["path"]))
    return groups


def _unique_names(header: Sequence[str]) -> list[str]:
    """pandas-style names: blanks -> 'Unnamed: i', repeats -> 'name.1', ..."""
    seen: dict[str, int] = {}
    out = []
    for i, h in enumerate(header):
        name = h if h != "" else f"Unnamed: {i}"
        if name in seen:
            seen[name] += 1
            name = f"{name}.{seen[name]}"
        else:
            seen[name] = 0
        out.append(name)
    return out


def read_catalog_csv(
    spark: SparkSession,
    path: str,
    multiline: bool = True,
    encoding: str = CSV_ENCODING,
    pattern: str = "*.csv",
) -> DataFrame:
    """S1 + S6: every CSV under ``path`` as one all-string DataFrame.

    ``multiline=True`` allows quoted fields with line breaks (each file is then
    read by one task); with ``False`` large files are split across tasks.
    """
    files = list_files(spark, path, pattern)
    groups = sniff_headers(spark, files, encoding)
    if not groups:
        schema = StructType([StructField(c, StringType()) for c in (*COLUMN_MAPPING.keys(),)])
        empty = spark.createDataFrame([], schema)
        return empty.select("*", *[F.lit(None).cast("string" if c in ("source_file", "file_path") else "bigint").alias(c)
                                   for c in SOURCE_COLUMNS])
    parts = []
    for header, group_files in sorted(groups.items()):
        names = _unique_names(header)
        schema = StructType([StructField(f"_c{i}", StringType()) for i in range(len(names))])
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("encoding", encoding)
            .option("multiLine", multiline)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(group_files)
        )
        parts.append(
            df.select(
                *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)],
                F.col("_metadata.file_name").alias("source_file"),
                F.col("_metadata.file_path").alias("file_path"),
                F.col("_metadata.file_block_start").alias("file_block_start"),
                F.monotonically_increasing_id().alias("row_pos"),
            )
        )
    return union_sources(parts)


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = COLUMN_MAPPING) -> DataFrame:
    """Raw header -> canonical name; unknown columns pass through."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def ensure_canonical(df: DataFrame, columns: Sequence[str] = CANONICAL_COLUMNS) -> DataFrame:
    """S3: add absent canonical columns as NULL strings."""
    missing = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def null_na_tokens(df: DataFrame, columns: Sequence[str] | None = None, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """NA tokens -> NULL in the string columns."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)
                       and f.name not in SOURCE_COLUMNS]
    return df.withColumns({c: null_tokens(c, tokens) for c in cols})


def ingest_frame(df: DataFrame) -> DataFrame:
    """X2 on an already-read frame: rename, ensure, NA tokens, ISBN text (P1),
    numeric year (P2)."""
    out = null_na_tokens(ensure_canonical(rename_columns(df)))
    return out.withColumns(
        {
            "isbn": stringify("isbn"),
            "year": coerce_numeric("year", out.schema["year"].dataType.simpleString()),
        }
    )


def ingest(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """CSV directory -> canonical ingested frame (plus source columns)."""
    return ingest_frame(read_catalog_csv(spark, path, multiline))
