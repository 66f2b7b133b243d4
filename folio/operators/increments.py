"""Keep-first over deliveries (D1-D4): a stored table of the least row per key.

:func:`keep_first` reads all rows at once.  Here rows arrive in deliveries, in
any order, and the table holds after each of them what one keep-first over
everything delivered so far would return.

A delivery is reduced to its first row per key (a partial aggregate before the
shuffle, so a hot key costs one row per task) and written as a *part* of its
own; stored rows are neither read nor rewritten.  Reading takes the least row
per key over all parts.  The least of a set does not depend on the order in
which rows come, on how they are split, or on a row that comes twice, so

* late and early deliveries give the same table;
* a delivery that is repeated (a replay after a lost driver) changes nothing,
  under its own name or another;
* :func:`compact` may write the table as one new part and delete the parts it
  read afterwards: if it stops in between, rows are there twice and the table
  is the same.  A part that was not finished has no success mark and is not
  read; parts that arrive while it runs are not deleted.

Parts are split by a hash of the key, ``buckets`` folders each, so compaction
and reading group rows of one bucket only, and :func:`lookup` of given keys
reads their buckets alone.

Defined results: with ``null_keys='group'`` NULL is a key like any other; with
``'keep'`` every row with a NULL key stays (D4).  Rows with equal keys and
equal order are one row (``order`` must be unique otherwise).  An empty
delivery writes an empty part.  Parts must share their columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.cleaning import keep_first
from folio.session import delete_path, finished_parts

BUCKETS = 64
BUCKET = "key_bucket"


def bucket_of(keys: Sequence[str | Column], buckets: int) -> Column:
    """Bucket of a key; NULL parts count as values."""
    marked = [F.coalesce(F.concat(F.lit("="), (F.col(k) if isinstance(k, str) else k).cast("string")), F.lit("")) for k in keys]
    return F.pmod(F.xxhash64(*marked), F.lit(buckets)).cast("int")


class FirstRows:
    """The stored table at ``path``.  ``keys``, ``order``, ``null_keys`` and
    ``buckets`` belong to the table and must be the same on every use."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ("row_pos",),
                 null_keys: str = "group", buckets: int = BUCKETS):
        if null_keys not in ("group", "keep"):
            raise ValueError(f"null_keys must be 'group' or 'keep', not {null_keys!r}")
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order, self.null_keys, self.buckets = list(keys), list(order), null_keys, buckets

    def _least(self, rows: DataFrame) -> DataFrame:
        """First row per key of rows that carry their bucket: the bucket is a
        function of the key, so it is one more grouping column."""
        if self.null_keys == "keep":
            # A NULL key's rows are told apart by their order; equal ones are one row.
            some_null = F.lit(False)
            for k in self.keys:
                some_null = some_null | F.col(k).isNull()
            rows = rows.withColumn("_solo", F.when(some_null, F.struct(*self.order)))
            return keep_first(rows, [BUCKET, *self.keys, "_solo"], self.order).drop("_solo")
        return keep_first(rows, [BUCKET, *self.keys], self.order)

    def deliver(self, delivery: DataFrame, name: str) -> None:
        """Add a delivery.  ``name`` is its id: a delivery under a name that is
        there already replaces that part."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", name):
            raise ValueError(f"a delivery's name has letters, digits and '-' only: {name!r}")
        self._write(self._least(delivery.withColumn(BUCKET, self._bucket())), f"{self.path}/delivery-{name}")

    def _bucket(self) -> Column:
        # Rows without a key never meet each other under 'keep': they are dealt by their order.
        if self.null_keys == "group":
            return bucket_of(self.keys, self.buckets)
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        return F.when(whole, bucket_of(self.keys, self.buckets)).otherwise(bucket_of(self.order, self.buckets))

    def _write(self, rows: DataFrame, path: str) -> None:
        # Rows of a bucket meet in a few tasks, which bounds the number of files;
        # the second hash keeps a bucket from being one task.
        dealt = rows.repartition(F.col(BUCKET), F.pmod(F.xxhash64(*self.keys, *self.order), F.lit(4)))
        # The schema is kept beside the rows, so that a part without rows can be read.
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(path)

    def parts(self) -> list[str]:
        """Finished parts.  One listing of the table's folder: a name per delivery since the last compaction."""
        return finished_parts(self.spark, self.path)

    def _stored(self, parts: Sequence[str]) -> DataFrame | None:
        out = None
        for part in parts:
            # Bucket folders are listed by the scan; a part without rows has none.
            make = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
            p = make(part)
            fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            if any(s.isDirectory() for s in fs.listStatus(p)):
                rows = self.spark.read.parquet(part)
                out = rows if out is None else out.unionByName(rows)
        return out

    def rows(self) -> DataFrame | None:
        """The first row of every key delivered so far (None: no rows yet)."""
        stored = self._stored(self.parts())
        return None if stored is None else self._least(stored).drop(BUCKET)

    def lookup(self, wanted: DataFrame) -> DataFrame | None:
        """First rows of the keys in ``wanted`` (its key columns are used).
        The buckets of few keys prune the scan."""
        stored = self._stored(self.parts())
        if stored is None:
            return None
        asked = wanted.select(*self.keys).distinct().withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        used = [r[BUCKET] for r in asked.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
        if len(used) < self.buckets:
            stored = stored.where(F.col(BUCKET).isin(used))
        match = F.lit(True)
        asked = asked.select(*(F.col(k).alias(f"_w{i}") for i, k in enumerate(self.keys)))
        for i, k in enumerate(self.keys):
            same = F.col(k).eqNullSafe(F.col(f"_w{i}")) if self.null_keys == "group" else F.col(k) == F.col(f"_w{i}")
            match = match & same
        return self._least(stored.join(asked, match, "left_semi")).drop(BUCKET)

    def effect(self, delivery: DataFrame) -> DataFrame:
        """What a delivery would change, before it is delivered: its first row
        per key and ``effect``, which is ``new``, ``earlier`` (it takes the
        place of a stored row) or ``none``.  Of the stored rows only the key
        and order columns are read."""
        first = self._least(delivery.withColumn(BUCKET, self._bucket()))
        stored = self._stored(self.parts())
        if stored is None:
            return first.drop(BUCKET).withColumn("effect", F.lit("new"))
        known = self._least(stored.select(BUCKET, *dict.fromkeys([*self.keys, *self.order])))
        known = known.select(F.col(BUCKET).alias("_b"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)),
                             F.struct(*(F.col(o).alias(f"o{i}") for i, o in enumerate(self.order))).alias("_known"))
        match = F.col(BUCKET) == F.col("_b")
        for i, k in enumerate(self.keys):
            match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        mine = F.struct(*(F.col(o).alias(f"o{i}") for i, o in enumerate(self.order)))
        if self.null_keys == "keep":
            some_null = F.lit(False)
            for k in self.keys:
                some_null = some_null | F.col(k).isNull()
            match = match & (~some_null | (F.col("_known") == mine))
        effect = F.when(F.col("_known").isNull(), "new").when(mine < F.col("_known"), "earlier").otherwise("none")
        names = [c for c in delivery.columns]
        return first.join(known, match, "left").select(*names, effect.alias("effect"))

    def compact(self) -> None:
        """One part instead of many.  Only the parts that were read are deleted, after the new one is finished."""
        old = self.parts()
        stored = self._stored(old)
        if len(old) < 2 or stored is None:
            return
        newest = max([int(m.group(1)) for p in old if (m := re.search(r"/merged-(\d+)$", p))], default=0)
        self._write(self._least(stored), f"{self.path}/merged-{newest + 1}")
        for part in old:
            delete_path(self.spark, part)
