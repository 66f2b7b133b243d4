"""Filtered, paged browsing (F3-F6, L1, L2, A8) and result fetching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.constants import DEFAULT_PAGE_SIZE, RECOMMEND_PAGE_SIZE, SEARCHABLE_FIELDS
from folio.functions import normalize_isbn
from folio.session import reliable_checkpoint

# The lower 33 bits of monotonically_increasing_id() are the row's position
# inside its partition (documented Spark behaviour).
_ROW_IN_PARTITION_MASK = (1 << 33) - 1


def _like_pattern(query: str) -> str:
    """Substring pattern with the user's text unescaped except for backslash.

    As in the reference, '%' and '_' typed by the user act as wildcards; a
    backslash is doubled because Spark's LIKE treats it as the escape char.
    """
    return "%" + query.lower().replace("\\", "\\\\") + "%"


def search_predicate(column: str, query: str, literal: bool = False) -> Column:
    col = F.lower(F.col(column).cast("string"))
    if literal:
        return col.contains(query.lower())
    return col.like(_like_pattern(query))


def search(
    df: DataFrame,
    field: str | None,
    query: str | None,
    allowed: Sequence[str] = SEARCHABLE_FIELDS,
    literal: bool = False,
) -> DataFrame:
    """case-insensitive substring filter on one allow-listed column.

    A no-op unless both ``field`` and ``query`` are given; any other field
    name is rejected.  ``%...%`` is never pushed into a Parquet scan, so this
    is a residual filter evaluated in generated code.
    """
    if not field or not query:
        return df
    if field not in allowed:
        raise ValueError(f"field {field!r} cannot be searched; allowed: {sorted(allowed)}")
    return df.where(search_predicate(field, query, literal))


def search_any(df: DataFrame, columns: Sequence[str], query: str, literal: bool = False) -> DataFrame:
    """substring match on any of ``columns``."""
    pred = F.lit(False)
    for c in columns:
        pred = pred | F.coalesce(search_predicate(c, query, literal), F.lit(False))
    return df.where(pred)


def lookup_isbn(df: DataFrame, isbn: str, column: str = "isbn") -> DataFrame:
    """exact match on the normalised ISBN.

    The normalisation of the literal is constant-folded by Catalyst, so the
    predicate reaches a Parquet scan as a pushed ``EqualTo`` filter.
    """
    return df.where(F.col(column) == normalize_isbn(F.lit(isbn)))


def _with_total(page: DataFrame, total: Column) -> DataFrame:
    """``page`` (a bounded number of rows) with the scalar ``total``; an empty
    page is one row of NULLs that still carries the total."""
    rows = page.agg(F.collect_list(F.struct(*page.columns)).alias("_rows")).select("_rows", total.alias("total"))
    out = rows.select(F.explode_outer("_rows").alias("_row"), "total")
    return out.select(*[F.col("_row")[c].alias(c) for c in page.columns], "total")


def browse(
    df: DataFrame,
    order: Sequence[str],
    skip: int = 0,
    limit: int = DEFAULT_PAGE_SIZE,
    field: str | None = None,
    query: str | None = None,
    allowed: Sequence[str] = SEARCHABLE_FIELDS,
) -> DataFrame:
    """L1 + A8: one page of matching rows plus the total number of matches.

    ``order`` must be a unique key so pages are stable.  The page is planned
    as ``TakeOrderedAndProject``: each task keeps skip + limit rows.  For
    pages far into a large result use :func:`browse_deep`, which gives the
    same rows.  The total is a scalar subquery (a separate global count),
    never a window over all rows; a page without rows is one row of NULLs
    with the total.
    """
    matches = search(df, field, query, allowed)
    total = matches.agg(F.count(F.lit(1))).scalar()
    ordered = matches.orderBy(*order)
    return _with_total((ordered.offset(skip) if skip else ordered).limit(limit), total)


def browse_deep(
    df: DataFrame,
    order: Sequence[str],
    skip: int,
    limit: int = DEFAULT_PAGE_SIZE,
    field: str | None = None,
    query: str | None = None,
    allowed: Sequence[str] = SEARCHABLE_FIELDS,
) -> DataFrame:
    """:func:`browse` without any task holding ``skip`` rows: the keys are
    numbered in a stage table, and only the page's keys fetch their rows."""
    matches = search(df, field, query, allowed)
    total = matches.agg(F.count(F.lit(1))).scalar()
    numbered = number_keys(matches, order).where((F.col("_row_number") > skip) & (F.col("_row_number") <= skip + limit))
    keys = numbered.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(order)])
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(order)]
    page = matches.join(F.broadcast(keys), same, "left_semi")  # at most ``limit`` keys
    return _with_total(page.orderBy(*order).limit(limit), total)


def number_keys(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``order`` columns with ``_row_number`` (1-based) and ``_total``.

    No global window (which would pull every row into one task): the keys
    alone are range-partitioned, sorted, and written once with their partition
    and position, so every later read sees the same split points.  Counts per
    partition give running offsets (one row per partition, broadcast).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns(
        {"_pid": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION_MASK))}
    )
    placed = reliable_checkpoint(placed, "numbered-keys")
    offsets = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        "_pid",
        (F.sum("_n").over(_running()) - F.col("_n")).alias("_off"),
        F.sum("_n").over(_all_rows()).alias("_total"),
    )
    return placed.join(F.broadcast(offsets), "_pid").select(
        *order, (F.col("_off") + F.col("_pos") + 1).alias("_row_number"), "_total"
    )


def with_pages(df: DataFrame, order: Sequence[str], size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """L2: global row number, page number (1-based) and page count per row.

    Keys are numbered by :func:`number_keys` and joined back to the other
    columns.  ``order`` must be a unique key.
    """
    numbered = number_keys(df, order)
    if set(df.columns) <= set(order):
        out = numbered
    else:
        keys = numbered.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(order)], "_row_number", "_total")
        same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(order)]
        out = df.join(keys, same)
    return out.select(
        *df.columns,
        F.col("_row_number").alias("row_number"),
        (F.floor((F.col("_row_number") - 1) / size).cast("bigint") + 1).alias("page"),
        F.greatest(F.lit(1), F.ceil(F.col("_total") / size)).cast("bigint").alias("total_pages"),
    )


def _running():
    # The counts table has one row per partition, so a single-task window over
    # it is bounded by the partition count, not by the data.
    return Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _all_rows():
    return Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def fetch_with_scores(books: DataFrame, results: DataFrame, key: str = "record_id") -> DataFrame:
    """J5 + J6 + L3: rows for the result ids with their score; ids missing
    from ``books`` are dropped by the inner join.

    ``results`` is a top-k result (queries x k rows).  No broadcast hint: its
    size is known only at run time, and adaptive execution turns the join
    into a broadcast join when the measured result is small (the usual case),
    keeping a shuffle join when many queries make it large.
    """
    return books.join(results, on=key, how="inner")


def page_results(
    results: DataFrame, group: str = "qid", rank: str = "rank", size: int = RECOMMEND_PAGE_SIZE
) -> DataFrame:
    """L2 for result lists: page of each fetched result within its query.

    Results are paged by their position in the fetched list (ids that were
    not found leave no gap).  The page size is ``min(size, results of the
    query)`` and the page count ``ceil(n / page size)``.  The windows are over
    one query's results, which a top-k result bounds by k rows.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(group))
    position = F.row_number().over(Window.partitionBy(group).orderBy(rank))
    return (
        results.withColumns({"_ps": F.least(F.lit(size).cast("bigint"), n), "_at": position})
        .withColumn("page", (F.floor((F.col("_at") - 1) / F.col("_ps")) + 1).cast("bigint"))
        .withColumn("total_pages", F.ceil(n / F.col("_ps")).cast("bigint"))
        .drop("_ps", "_at")
    )
