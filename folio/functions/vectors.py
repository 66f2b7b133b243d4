"""Array-of-number column builders (computed in double precision)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two equally long numeric arrays, in double."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def squared_norm(v: Column | str) -> Column:
    return F.aggregate(
        _col(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(squared_norm(v))


def l2_normalize(v: Column | str) -> Column:
    """V3: divide by the L2 norm; a zero vector stays zero."""
    col = _col(v)
    norm = l2_norm(col)
    return F.when(norm > 0, F.transform(col, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(col, lambda x: x.cast("double") * 0.0)
    )


def round_vector(v: Column | str, digits: int) -> Column:
    """Round every element (for stable comparison of double vectors)."""
    return F.transform(_col(v), lambda x: F.round(x, digits))
