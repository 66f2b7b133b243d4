"""Data-quality reports per stage (A1-A10).

All reports are global aggregates: one partial aggregate per task, one tiny
final merge, so they cost a single scan however skewed the data is.  Distinct
counts de-duplicate map-side before the shuffle; ``approx=True`` switches to
HyperLogLog++ when an exact count is not required.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.constants import INDEX_METRIC, STATUS_FOUND, STATUS_MISSING


def _distinct(c: str, approx: bool):
    return F.approx_count_distinct(c) if approx else F.count_distinct(F.col(c))


def profile(
    df: DataFrame,
    distinct: Sequence[str] = (),
    missing: Sequence[str] = (),
    present: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """A1-A3: row count, distinct (NULL-ignoring), missing and present counts."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [_distinct(c, approx).cast("bigint").alias(f"n_distinct_{c}") for c in distinct]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n_missing_{c}") for c in missing]
    aggs += [F.count(c).alias(f"n_present_{c}") for c in present]
    return df.agg(*aggs)


def enrichment_stats(df: DataFrame, status: str = "status") -> DataFrame:
    """A4: processed / found / missing counts and success rate in % (2 dp)."""
    s = F.col(status)
    return df.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(s == STATUS_FOUND).alias("found_books"),
        F.count_if(s == STATUS_MISSING).alias("missing_books"),
        F.round(100.0 * F.avg((s == STATUS_FOUND).cast("double")), 2).alias("success_rate_pct"),
    )


def by_status(df: DataFrame, status: str, column: str = "status") -> DataFrame:
    """records with one enrichment outcome (a pushed-down equality filter)."""
    return df.where(F.col(column) == status)


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: non-NULL count per column, named ``<col>_available``."""
    return df.agg(*[F.count(c).alias(f"{c}_available") for c in cols])


def removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before, after and removed between two stages (one row)."""
    n_after = after.agg(F.count(F.lit(1))).scalar()
    return (
        before.agg(F.count(F.lit(1)).alias("rows_before"))
        .withColumn("rows_after", n_after)
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )


def stage_summary(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One (stage, n_rows) row per named stage, in the given order."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("stage"), F.lit(i).alias("stage_order"), "n_rows"
        )
        for i, (name, df) in enumerate(stages.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def store_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """Final store statistics."""
    return df.agg(
        _distinct("book_key", approx).cast("bigint").alias("final_books_count"),
        _distinct("title", approx).cast("bigint").alias("unique_titles"),
        _distinct("isbn", approx).cast("bigint").alias("unique_isbn"),
    )


def index_metadata(emb: DataFrame, vector: str = "embedding") -> DataFrame:
    """A10: vector count, dimension, number of distinct dimensions and metric."""
    return emb.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.max(F.size(vector)).cast("bigint").alias("dimension"),
        F.count_distinct(F.size(vector)).cast("bigint").alias("n_dimensions"),
    ).withColumn("metric", F.lit(INDEX_METRIC))
