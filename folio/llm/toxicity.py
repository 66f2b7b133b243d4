"""Toxicity severity by cumulative-link ordinal regression.

For grades 0..K the model is P(grade >= k | x) = sigmoid(w.x - t_k) with one
weight vector shared by all ordered thresholds t_1 <= ... <= t_K.  Features
are sparse: which hash buckets the text's words, and the first
``PREFIX`` bytes of longer words, fall into.  The likelihood is maximised by
proximal gradient steps with an L1 penalty, so buckets of ordinary words get
weight 0 and long texts gather no noise.  The output is the expected severity
sum_k P(grade >= k).

Learning rows are a bounded sample (per grade the ``PER_GRADE`` rows with the
smallest hash of doc_id); scores cover every document and its whole text.

Defined results: a null or empty text has no features and gets the model's
base severity.  Missing grades are not learned from; with no graded row every
severity is 0, with one grade only it is that grade.  Rows without doc_id are
scored.  Extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordhash as wh
from folio.llm.common import Stages, map_text, row_chunks, text_bytes
from folio.llm.langid import labelled_sample, sample_labelled

BITS = 18
PREFIX = 5
PER_GRADE = 1500
PENALTY = 2e-4
ROUNDS = 300

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def letter_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row bounds of runs of letters (bytes over x7F are
    letters here)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of the texts, by row."""
    low = wh.LOWER[data]
    starts, ends, rows = letter_words(low, offs)
    owner = np.arange(len(offs) - 1).repeat(np.diff(rows))
    long = ends - starts > PREFIX
    word = wh.word_hashes(low, starts, ends)
    head = wh.finalise(wh.word_hashes(low, starts[long], starts[long] + PREFIX) ^ np.uint64(0x5DEECE66D))
    bucket = np.concatenate([word, head]) >> np.uint64(64 - BITS)
    pair = np.unique((np.concatenate([owner, owner[long]]).astype(np.uint64) << np.uint64(BITS)) | bucket)
    return (pair >> np.uint64(BITS)).astype(np.int64), (pair & np.uint64((1 << BITS) - 1)).astype(np.int64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class SeverityModel:
    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts



def fit_ordinal(row: np.ndarray, bucket: np.ndarray, grade: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> SeverityModel:
    """Shared weights and ordered cuts for rows given by their (row, bucket)
    pairs, by accelerated proximal gradient (FISTA)."""
    k = int(grade.max()) if len(grade) else 0
    if not len(grade) or grade.min() == k:  # nothing to tell apart
        return SeverityModel(np.zeros(1 << BITS), np.full(k, -40.0))
    used, col = np.unique(bucket, return_inverse=True)
    n = len(grade)
    above = grade[:, None] >= np.arange(1, k + 1)[None, :]
    share = above.mean(axis=0).clip(1e-4, 1 - 1e-4)
    cuts = -np.log(share / (1 - share))
    counts = np.bincount(row, minlength=n)
    rate = 4.0 / (k * max(1.0, counts.mean()))
    w = np.zeros(len(used))
    v, old_t = w.copy(), 1.0
    for _ in range(rounds):
        score = np.bincount(row, weights=v[col], minlength=n)
        miss = sigmoid(score[:, None] - cuts[None, :]) - above  # of the K shared-weight splits
        grad = np.bincount(col, weights=(miss.sum(axis=1) / n)[row], minlength=len(used))
        new = v - rate * grad * np.sqrt(n)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty * np.sqrt(n), 0)
        t = (1 + np.sqrt(1 + 4 * old_t**2)) / 2
        v, w, old_t = new + (old_t - 1) / t * (new - w), new, t
        cuts = np.maximum.accumulate(cuts + 2.0 * miss.mean(axis=0))
    full = np.zeros(1 << BITS)
    full[used] = w
    return SeverityModel(full, cuts)


def fit(docs: DataFrame, grade: str, per_grade: int = PER_GRADE) -> SeverityModel:
    """Learn from the rows of ``docs`` that have a ``grade`` (0, 1, ...)."""
    rows = sample_labelled(docs.filter(F.col(grade) >= 0), grade, per_grade)

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("text"))
        row, bucket = features(data, offs)
        cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.ListArray.from_arrays(pa.array(cut), pa.array(bucket, pa.int32()))], names=["grade", "buckets"])

    got = map_text(rows.select(F.col(grade).cast("int").alias("grade"), F.col("text").cast("string")), fn, "grade int, buckets array<int>")
    got = got.orderBy("grade", "buckets").toPandas()
    size = got["buckets"].map(len).to_numpy(int) if len(got) else np.zeros(0, int)
    bucket = np.concatenate(got["buckets"].tolist()) if size.sum() else np.zeros(0, int)
    return fit_ordinal(np.arange(len(got)).repeat(size), bucket, got["grade"].to_numpy(int))


def predict(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """doc_id, severity (expected grade), at_least (P(grade >= k), k = 1..K)
    and grade (the most probable one; the lower one in a tie)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.cuts))

    def fn(batch: pa.RecordBatch):
        weights, cuts = shared.value
        data, offs = text_bytes(batch.column("text"))
        score = np.zeros(batch.num_rows)
        for lo, hi in row_chunks(offs):
            row, bucket = features(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            score[lo:hi] = np.bincount(row, weights=weights[bucket], minlength=hi - lo)
        p = sigmoid(score[:, None] - cuts[None, :])  # P(grade >= k), k = 1..K
        each = np.concatenate([np.ones((len(p), 1)), p], axis=1) - np.concatenate([p, np.zeros((len(p), 1))], axis=1)
        cut = np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(p.sum(axis=1)), pa.ListArray.from_arrays(pa.array(cut), pa.array(p.ravel())), pa.array(each.argmax(axis=1), pa.int32())],
            names=["doc_id", "severity", "at_least", "grade"])

    return map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fn,
                    "doc_id long, severity double, at_least array<double>, grade int")


def graded(docs: DataFrame, labels: DataFrame, toxic: str = "toxic", per_label: int = 2 * PER_GRADE) -> DataFrame:
    """A bounded sample of ``docs`` with ``grade`` from the 0/1 mark in
    ``labels``: 0 unmarked, 1 marked, 2 marked and with more words that speak
    for the mark than the typical (median) marked text.  Words speak for the
    mark through a first, two-grade fit on the same rows."""
    marks = labels.select("doc_id", F.col(toxic).cast("int").alias("toxic")).filter("toxic in (0, 1)")
    sample = Stages(docs.sparkSession, "toxicity").put(labelled_sample(docs, marks, "toxic", per_label), "sample")
    model = fit(sample.withColumn("grade", F.col("toxic")), "grade", per_label)
    strong = docs.sparkSession.sparkContext.broadcast(np.flatnonzero(model.weights > 0.5 * max(1e-9, model.weights.max())))

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("text"))
        row, bucket = features(data, offs)
        n = np.bincount(row[np.isin(bucket, strong.value)], minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names), pa.array(n, pa.int32())], names=[*batch.schema.names, "hits"])

    rows = map_text(sample.select("doc_id", "text", "toxic"), fn, "doc_id long, text string, toxic int, hits int")
    typical = rows.filter("toxic = 1").agg(F.percentile_approx("hits", 0.5)).first()[0] or 0
    return rows.withColumn("grade", F.when(F.col("toxic") == 0, 0).when(F.col("hits") > typical, 2).otherwise(1))
