"""Dense vector columns: which rows take part, and their matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole numbers of this size are still exact as doubles.
EXACT = float(1 << 53)


def finite(vector: Column) -> Column:
    """The vector and all its components are there, and none is NaN or
    infinite (an empty vector passes)."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def floored(vector: Column, scale: float, most: float = EXACT) -> Column:
    """floor(scale * component) as longs; products beyond ``most`` count as
    ``most`` (so no component is too large for the whole numbers used)."""
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c * F.lit(scale), F.lit(-most)), F.lit(most))).cast("long"))


def padded(vector: Column, width: int, value) -> Column:
    """The vector, followed by ``value`` up to ``width`` components."""
    return F.concat(vector, F.array_repeat(F.lit(value), F.greatest(F.lit(width) - F.size(vector), F.lit(0))))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists have equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def spread(df: DataFrame, rows: int, per_file: int = 100_000) -> DataFrame:
    """A counted table dealt out evenly: one file per ``per_file`` rows, and
    for a small table two per task slot, but none of a few hundred rows."""
    slots = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, -(-rows // per_file), min(slots, rows // 1024)))
