"""Mergeable distinct counts (A2, A9): stored sketches, one part per delivery.

:func:`folio.operators.quality.profile` counts distinct values exactly, from
all rows at once; that stays the default.  Here a delivery leaves one small row
per group behind: its counts and one HyperLogLog sketch per column.  Any set of
parts is merged later without reading the rows again, so

* the distinct count over all deliveries, over some of them, or over a coarser
  grouping (months out of days) costs a scan of the sketches, some 2^lg_k bytes
  each;
* values that several stages share are counted once by the union, which no sum
  of exact counts gives; :func:`overlap` derives the number shared.

Merging does not depend on order, and a value that comes twice changes nothing
in a sketch.  Row counts are sums, so a delivery that is repeated must come
under its own name again: it then replaces its part.

``error`` bounds the relative error of an estimate at three standard errors of
a merged sketch, 1.04 / sqrt(2^lg_k) each: 2.5 % for the default of 14.

Defined results: NULL is no value; a column without values has 0; an empty
delivery adds nothing; without ``by`` there is one row, also over no rows; a
NULL group is a group like any other.  Columns are counted by their text, so
any type that casts to a string will do.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.session import finished_parts

LG_K = 14


def error(lg_k: int = LG_K) -> float:
    """Relative error that an estimate keeps within (three standard errors)."""
    return 3 * 1.04 / (1 << lg_k) ** 0.5


def sketch(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """One row per group: ``n_rows``, and ``n_missing_<c>`` and ``sketch_<c>``
    per column.  The sketches are built map-side, so a hot group costs one
    sketch per task."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n_missing_{c}"))
        aggs.append(F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"sketch_{c}"))
    return rows.groupBy(*by).agg(*aggs)


def merge(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketched rows put together per group of ``by``, sketched as before."""
    aggs = [F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")]
    for c in columns:
        aggs.append(F.coalesce(F.sum(f"n_missing_{c}"), F.lit(0)).alias(f"n_missing_{c}"))
        aggs.append(F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}"))
    return sketches.groupBy(*by).agg(*aggs)


def _count(sketched: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketched), F.lit(0).cast("bigint"))


def estimates(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n_rows``, and per column ``n_distinct_<c>`` (estimated) and ``n_missing_<c>``."""
    merged = merge(sketches, columns, by)
    out = [F.col(c) for c in by] + [F.col("n_rows")]
    for c in columns:
        out += [_count(F.col(f"sketch_{c}")).alias(f"n_distinct_{c}"), F.col(f"n_missing_{c}")]
    return merged.select(*out)


def overlap(one: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: ``n_one`` and ``n_other`` distinct values, ``n_union`` and
    ``n_shared`` (their sum less the union, at least 0).  The error of
    ``n_shared`` is a share of the union, not of itself."""
    side = [merge(s, columns) for s in (one, other)]
    both = merge(side[0].unionByName(side[1]), columns)

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("column"), _count(F.col(f"sketch_{c}")).alias(name)) for c in columns]
        return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")

    # One row per column on every side.
    out = long(side[0], "n_one").join(long(side[1], "n_other"), "column").join(long(both, "n_union"), "column")
    return out.withColumn("n_shared", F.greatest(F.lit(0).cast("bigint"), F.col("n_one") + F.col("n_other") - F.col("n_union")))


class SketchTable:
    """Sketches stored under ``path``, one part per delivery.  ``columns``,
    ``by`` and ``lg_k`` belong to the table."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K):
        self.spark, self.path = spark, path.rstrip("/")
        self.columns, self.by, self.lg_k = list(columns), list(by), lg_k

    def deliver(self, rows: DataFrame, name: str) -> None:
        """Sketch a delivery; one under a name that is there replaces it."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", name):
            raise ValueError(f"a delivery's name has letters, digits and '-' only: {name!r}")
        sketch(rows, self.columns, self.by, self.lg_k).write.mode("overwrite").parquet(f"{self.path}/delivery-{name}")

    def parts(self) -> list[str]:
        return finished_parts(self.spark, self.path)

    def stored(self, names: Sequence[str] | None = None) -> DataFrame | None:
        """The sketched rows of all deliveries, or of those named (None: no part)."""
        parts = self.parts()
        if names is not None:
            wanted = {f"delivery-{n}" for n in names}
            parts = [p for p in parts if p.rsplit("/", 1)[1] in wanted]
        return self.spark.read.parquet(*parts) if parts else None

    def estimates(self, by: Sequence[str] | None = None, names: Sequence[str] | None = None) -> DataFrame | None:
        """Counts per group of ``by`` (some of the table's own columns; default: all of them)."""
        by = self.by if by is None else list(by)
        if not set(by) <= set(self.by):
            raise ValueError(f"sketched by {self.by}, which {by} can't be put together from")
        stored = self.stored(names)
        return None if stored is None else estimates(stored, self.columns, by)
