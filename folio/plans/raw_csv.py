"""The derived catalogue as CSV files, for the queries that ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.session import scratch_path
from folio.sources.catalog_csv import ingest
from folio.sources.catalog_views import catalog_raw
from folio.sources.sinks import write_csv

# Three header layouts the raw catalogue is written in: full, reordered, and
# one without "Page(s)" but with an extra column.
_FULL = [
    ("accession_no", "Acc. No."),
    ("title", "Title"),
    ("author_editor", "Author/Editor"),
    ("isbn", "ISBN"),
    ("year", "Year"),
    ("pages", "Page(s)"),
    ("class_no_book_no", "Class No./Book No."),
    ("summary", "Summary"),
]
_REORDERED = [_FULL[i] for i in (4, 1, 3, 0, 2, 5, 6, 7)]
_NO_PAGES = [c for c in _FULL if c[0] != "pages"] + [("class_no_book_no", "Extra")]

#: Rows of the layout without pages (valid in Spark SQL and DuckDB).
NO_PAGES_ROWS = "row_pos % 3 = 2"


def write_raw_csv(spark, sf_dir: str, path: str) -> None:
    """Every row of the raw catalogue as Latin-1 CSV, a third of the rows in
    each of three header layouts."""
    raw = catalog_raw(spark, sf_dir)
    for third, layout in enumerate((_FULL, _REORDERED, _NO_PAGES)):
        part = raw.where(F.pmod("row_pos", F.lit(3)) == third).select(*[F.col(src).alias(header) for src, header in layout])
        write_csv(part, path, mode="append", encoding="ISO-8859-1")


def ingested_catalog(spark, sf_dir: str) -> DataFrame:
    """The catalogue written as CSV files and ingested back."""
    path = scratch_path(spark, "raw-csv")
    write_raw_csv(spark, sf_dir, path)
    return ingest(spark, path)
