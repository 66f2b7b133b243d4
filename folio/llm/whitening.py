"""Whitening of embeddings from an exact covariance by polarisation.

Components c become whole numbers x = floor(64 c) + 1000000, so that sums and
squares are exact at any size.

Method
  1. The fit list holds each distinct x vector once (copies collapse in the
     partial aggregate, before the shuffle).  Its size n and the sums S of
     every dimension come from one pass.
  2. A second pass centres x on the whole number nearest to S/n and adds up
     the squares of every dimension and of the sum of every two dimensions,
     as exact whole numbers (in 64 bits where they fit, in Python's whole
     numbers elsewhere).  What rounding the centre left out is put right
     exactly, n * sum(y^2) - sum(y)^2, so these are the variances of x_i and
     of x_i + x_j about their true means.
  3. cov(i, j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2: every entry is
     one correctly rounded quotient of two whole numbers.  The matrix, d by
     d, is all that reaches the driver; numpy's eigh takes it apart.
  4. A last pass over the fit list measures the covariance of what the
     whitening makes of it.

Defined results: rows whose vector is null or has a null or non-finite
component are left out.  A shorter vector counts as 0 beyond its end; 64 c
beyond 2^53 counts as 2^53.  Repeated rows, and rows without vec_id, all come
back.  A component without variance (fewer distinct vectors than dimensions)
has ``whitened`` null and takes no part in ``identity_error``; without any
variance ``explained`` is null.  ``deviation`` is null beyond 38 digits.
Further columns are ignored.  An empty table gives none.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import Stages, release_memory
from folio.llm.dense import finite, floored, matrix, padded, spread

SCALE, SHIFT, COMPONENTS = 64.0, 1_000_000, 16
CHUNK = 1024
LIMB = 40
LIMBS = ["l0 long", "l1 long", "l2 long", "l3 long"]
FITS = 1 << 62


def exact_sum(a: np.ndarray, most: int) -> np.ndarray:
    """Column sums of whole numbers of at most ``most``, as Python numbers."""
    return a.sum(axis=0).astype(object) if most * max(1, len(a)) < FITS else a.astype(object).sum(axis=0)


def limbs(values) -> list[list[int]]:
    """Whole numbers in base 2^40, lowest first; the last one has the sign."""
    low, out = (1 << LIMB) - 1, []
    rest = [int(v) for v in values]
    for _ in range(3):
        out.append([v & low for v in rest])
        rest = [v >> LIMB for v in rest]
    return [*out, rest]


def total(df: DataFrame) -> dict[int, int]:
    """Sums by key k of limbs that tasks returned (a bounded number of keys)."""
    rows = df.groupBy("k").agg(*(F.sum(c.split()[0]).alias(c.split()[0]) for c in LIMBS)).collect()
    return {r.k: sum(r[f"l{i}"] << (LIMB * i) for i in range(4)) for r in rows}


def _partial(table: DataFrame, chunk_sums, keys: int) -> DataFrame:
    """``chunk_sums`` of every chunk of x rows, added up within the task."""

    def run(batches):
        held = np.zeros(keys, object)
        some = False
        for batch in batches:
            x = matrix(batch.column("x"))
            for lo in range(0, len(x), CHUNK):
                held += chunk_sums(x[lo:lo + CHUNK])
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(keys)), *(pa.array(c, pa.int64()) for c in limbs(held))],
                                             names=["k", "l0", "l1", "l2", "l3"])
        release_memory()

    return table.select("x").mapInArrow(run, "k long, " + ", ".join(LIMBS))


def pair_squares(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Sums of squares of x_i - c_i, then of (x_i - c_i) + (x_j - c_j) for
    i < j in row order, exact."""
    y = x - centre
    most = 4 * int(np.abs(y).max(initial=0)) ** 2
    if most >= FITS:
        y = y.astype(object)
    parts = [exact_sum(y * y, most)]
    for i in range(y.shape[1] - 1):
        two = y[:, i + 1:] + y[:, i:i + 1]
        parts.append(exact_sum(two * two, most))
    return np.concatenate(parts)


class Whitening:
    """What was fitted: n, sums, covariance, eigenvectors and their scales."""

    def __init__(self, n: int, sums: list[int], squares: list[int], components: int):
        d = len(sums)
        self.n, self.sums = n, sums
        self.centre = [(2 * s + n) // (2 * n) for s in sums]
        self.left = [s - n * c for s, c in zip(sums, self.centre)]  # sums of x - centre
        var = [n * squares[i] - self.left[i] ** 2 for i in range(d)]
        self.cov = np.zeros((d, d))
        k = d
        for i in range(d):
            self.cov[i, i] = var[i] / (n * n)
            for j in range(i + 1, d):
                both = n * squares[k] - (self.left[i] + self.left[j]) ** 2
                self.cov[i, j] = self.cov[j, i] = (both - var[i] - var[j]) / (2 * n * n)
                k += 1
        value, vector = np.linalg.eigh(self.cov)
        value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
        trace = sum(var) / (n * n)
        self.real = value > (1e-12 * d * max(value[0], 0.0) if d else 0.0)
        self.axes = vector[:, self.real] / np.sqrt(value[self.real])
        self.explained = [float(max(v, 0.0)) / trace if trace else None for v in value]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of x rows (components with variance only)."""
        y = (x - np.array(self.centre, np.int64)).astype(float) - np.array([t / self.n for t in self.left])
        return y @ self.axes

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact."""
        y = x - np.array(self.centre, np.int64)
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * max(1, y.shape[1]) < FITS:
            z = self.n * y - np.array(self.left, np.int64)
            return (z * z).sum(axis=1).tolist()
        z = self.n * y.astype(object) - np.array(self.left, object)
        return (z * z).sum(axis=1).tolist()


def fit(fit_list: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of distinct x vectors (column x); None of an empty list."""

    def firsts(x):
        return np.concatenate([[len(x)], exact_sum(x, int(np.abs(x).max(initial=0)))])

    first = total(_partial(fit_list, firsts, width + 1))
    if not first:
        return None
    n, sums = first[0], [first[i + 1] for i in range(width)]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    squares = total(_partial(fit_list, lambda x: pair_squares(x, centre), width * (width + 1) // 2)) if width else {}
    return Whitening(n, sums, [squares[i] for i in range(len(squares))], components)


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the
    identity, measured on the list."""
    k = int(model.real.sum())
    if not k:
        return 0.0

    def run(batches):
        held, some = np.zeros((k + 1, k)), False
        for batch in batches:
            x = matrix(batch.column("x"))
            for lo in range(0, len(x), CHUNK):
                w = model.project(x[lo:lo + CHUNK])
                held[0] += w.sum(axis=0)
                held[1:] += w.T @ w
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(held.size)), pa.array(held.ravel())], names=["k", "s"])

    sums = dict(fit_list.select("x").mapInArrow(run, "k long, s double").groupBy("k").agg(F.sum("s")).collect())
    held = np.array([sums[i] for i in range(k * (k + 1))]).reshape(k + 1, k) / model.n
    return float(np.abs(held[1:] - np.outer(held[0], held[0]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation (decimal), ``whitened`` and ``explained`` (arrays
    over the components) and identity_error of every row with a finite
    ``embedding``."""
    st = Stages(vectors.sparkSession, "whiten")
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).filter(finite(F.col("v")))
    rows = st.put(rows.select("vec_id", F.transform(floored(F.col("v"), SCALE), lambda q: q + F.lit(SHIFT).cast("long")).alias("x")), "rows")
    width, short = rows.agg(F.max(F.size("x")), F.min(F.size("x"))).first()
    if short != width:
        rows = rows.withColumn("x", padded(F.col("x"), width, SHIFT).cast("array<long>"))
    distinct = st.put(rows.select("x").distinct(), "distinct")
    distinct = st.put(spread(distinct, distinct.count()), "fit")
    st.drop("distinct")
    out = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    model = fit(distinct, width or 0, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], out)
    error = identity_error(distinct, model)
    count = len(model.explained)

    def run(batches):
        at = np.flatnonzero(model.real)
        exact = decimal.Context(prec=60)
        for batch in batches:
            x = matrix(batch.column("x")).astype(np.int64)
            m = len(x)
            if not m:
                continue
            w, there = np.zeros((m, count)), np.zeros((m, count), bool)
            w[:, at], there[:, at] = model.project(x), True
            deviation = [exact.create_decimal(v) if v < 10**38 else None for v in model.deviation(x)]
            offsets = pa.array(np.arange(m + 1, dtype=np.int32) * count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(np.full(m, model.n)), pa.array(deviation, pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(offsets, pa.array(w.ravel(), mask=~there.ravel())),
                 pa.ListArray.from_arrays(offsets, pa.array(model.explained * m, pa.float64())), pa.array(np.full(m, error))],
                names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, out)
