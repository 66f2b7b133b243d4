"""Paging from a stored range index (L1): any page costs the ranges it lies in.

:func:`folio.operators.search.browse` sorts on every request and
``browse_deep`` numbers all keys on every request.  :class:`PageIndex` does
that once: the rows are range-partitioned by the order key, sorted, and written
with their range and their position in it, one folder per range.  A small table
holds each range's row count, offset, first and last key.

* :meth:`PageIndex.page` finds the ranges of rows skip + 1 to skip + limit in
  the small table; the scan is pruned to their folders, and the positions are
  pushed into it.
* :meth:`PageIndex.seek` continues after a key that the caller has seen: ranges
  that end before it are pruned in the same way.

Nothing is sorted per request but the page's own rows.  The index is a copy in
the state of its build; its table of ranges is written last, so an index whose
build did not finish cannot be opened.

Defined results: ``order`` must be a unique key (as for ``browse``); NULL sorts
first; a page beyond the end, or of an empty table, has no rows; keys need not
exist to be sought after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.constants import DEFAULT_PAGE_SIZE
from folio.session import finished_parts

RANGE, POSITION = "_range", "_pos"
_IN_PARTITION = (1 << 33) - 1


class PageIndex:
    """The index stored under ``path``, ordered by ``order``."""

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str]):
        self.spark, self.path, self.order = spark, path.rstrip("/"), list(order)
        finished = {p.rsplit("/", 1)[1] for p in finished_parts(spark, self.path)}
        if not {"rows", "ranges", "columns"} <= finished:
            raise ValueError(f"no finished index under {path}")
        schema = spark.read.parquet(f"{self.path}/columns").schema
        self.columns = [c for c in schema.names if c not in (RANGE, POSITION)]
        self._rows = spark.read.schema(schema).parquet(f"{self.path}/rows")
        self._ranges = spark.read.parquet(f"{self.path}/ranges")

    @classmethod
    def build(cls, df: DataFrame, path: str, order: Sequence[str], ranges: int | None = None) -> "PageIndex":
        """Index ``df`` in about ``ranges`` parts (default: the shuffle partitions)."""
        spark, path = df.sparkSession, path.rstrip("/")
        n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id())
        placed = placed.sortWithinPartitions(RANGE, *order).withColumn(POSITION, F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)))
        placed.write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/rows")
        placed.limit(0).write.mode("overwrite").parquet(f"{path}/columns")
        stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
        key = F.struct(*order)
        counted = stored.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
        # One row per range, so the windows in one task are bounded by the number of ranges.
        before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        counted.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")
        return cls(spark, path, order)

    def total(self) -> Column:
        """Number of rows (a scalar subquery on the small table)."""
        return self._ranges.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).scalar()

    def page(self, skip: int = 0, limit: int = DEFAULT_PAGE_SIZE) -> DataFrame:
        """Rows skip + 1 to skip + limit, in order."""
        if skip < 0 or limit < 0:
            raise ValueError("skip and limit must not be negative")
        # Ranges hold at least one row each: at most ``limit`` of them.
        held = self._ranges.where((F.col("start") < skip + limit) & (F.col("start") + F.col("n") > skip)).select(RANGE, "start", "n").collect()
        wanted = F.lit(False)
        for r in held:
            lo, hi = max(0, skip - r["start"]), min(r["n"], skip + limit - r["start"])
            wanted = wanted | ((F.col(RANGE) == r[RANGE]) & (F.col(POSITION) >= lo) & (F.col(POSITION) < hi))
        return self._sorted(self._rows.where(F.col(RANGE).isin([r[RANGE] for r in held]) & wanted), limit)

    def seek(self, after: Sequence, limit: int = DEFAULT_PAGE_SIZE) -> DataFrame:
        """The ``limit`` rows after the key ``after`` (values in the order of ``order``)."""
        if len(after) != len(self.order):
            raise ValueError(f"a key has {len(self.order)} values: {self.order}")
        types = {f.name: f.dataType for f in self._rows.schema}
        key = F.struct(*(F.lit(v).cast(types[c]).alias(c) for c, v in zip(self.order, after)))
        # The first range may have one row left; the following ones count in full.
        later = self._ranges.where(F.col("last") > key)
        before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        first = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        full = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.when(F.row_number().over(Window.orderBy(RANGE)) > 1, F.first("n").over(first)).otherwise(0)
        held = [r[RANGE] for r in later.select(RANGE, full.alias("full")).where(F.col("full") < limit).collect()]
        rows = self._rows.where(F.col(RANGE).isin(held) & (F.struct(*self.order) > key))
        if after[0] is not None:  # a plain comparison reaches the scan
            rows = rows.where(F.col(self.order[0]) >= F.lit(after[0]).cast(types[self.order[0]]))
        return self._sorted(rows, limit)

    def _sorted(self, rows: DataFrame, limit: int) -> DataFrame:
        return rows.orderBy(*self.order).limit(limit).select(*self.columns)
