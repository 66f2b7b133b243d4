"""Document quality by a byte-level convolutional network.

Overlapping chunks cover the whole document.  A numpy network (embedded
bytes, filters of widths 2 to 5, max pooling over positions) gives every
chunk a logit; the mean, the smallest and the largest chunk logit of the
document are combined by a logistic layer into one probability.

The network is trained on chunks of a bounded sample of labelled documents,
the combining layer on all chunks of the same documents.  Scores cover every
document and every byte; labels, lang, source and doc_id are never inputs.

Defined results: a null or empty text is one chunk of padding and is scored
like any other.  Missing labels are not learned from; with no label, or only
one kind, the score is that kind's share (0.5 without any).  Rows without
doc_id are scored.  Extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import bytecnn
from folio.llm.common import Stages, map_column, row_chunks, text_bytes
from folio.llm.langid import labelled_sample, training_windows

LENGTH = 256
STRIDE = 224
PER_LABEL = 1500
CHUNKS_PER_TEXT = 4
STEPS = 700


class QualityModel:
    def __init__(self, net: dict | None, combine: np.ndarray, base: float):
        self.net, self.combine, self.base = net, combine, base


def chunk_summary(net: dict, texts: pa.Array) -> np.ndarray:
    """Mean, smallest and largest chunk logit of every text, and 1."""
    data, offs = text_bytes(texts)
    out = np.ones((len(offs) - 1, 4))
    for lo, hi in row_chunks(offs, 1 << 18):
        x, owner, filled = bytecnn.windows(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], LENGTH, STRIDE)
        z = bytecnn.logits(net, x)
        z = (z[:, 1] - z[:, 0]).astype(float)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        out[lo:hi, 0] = np.add.reduceat(z * filled, first) / np.add.reduceat(filled, first)
        out[lo:hi, 1] = np.minimum.reduceat(z, first)
        out[lo:hi, 2] = np.maximum.reduceat(z, first)
    return out


def summaries(docs: DataFrame, net: dict, text: str = "text"):
    """Column with the chunk summary of every whole text."""
    net_ = docs.sparkSession.sparkContext.broadcast(net)

    def run(texts: pa.Array) -> pa.Array:
        got = chunk_summary(net_.value, texts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1, dtype=np.int32) * 4), pa.array(got.ravel()))

    return map_column(docs.sparkSession, run, "array<double>", F.col(text))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str, per_label: int = PER_LABEL, steps: int = STEPS) -> QualityModel:
    """Learn from the rows of ``docs`` whose ``label`` in ``labels`` (doc_id
    and label) is 0 or 1."""
    known = labels.filter(F.col(label).isin(0, 1))
    counts = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}  # two rows
    total = sum(counts.values())
    base = counts.get(1, 0) / total if total else 0.5
    if len(counts) < 2:
        return QualityModel(None, np.zeros(4), base)
    rows = Stages(docs.sparkSession, "quality").put(labelled_sample(docs, known, label, per_label), "sample")
    x, y = training_windows(rows, label, LENGTH, STRIDE, CHUNKS_PER_TEXT)
    net = bytecnn.train(x, np.array(y, np.int64), 2, steps)
    got = rows.select(F.col(label).alias("y"), summaries(rows, net).alias("x")).orderBy("y", "x").toPandas()
    sx, sy = np.array(got["x"].tolist()), got["y"].to_numpy(float)
    # The sample holds both labels alike; the intercept is moved to their shares.
    w = logistic(sx, sy)
    share = sy.mean()
    w[3] += np.log(base / (1 - base)) - np.log(share / (1 - share))
    return QualityModel(net, w, base)


def predict(docs: DataFrame, model: QualityModel, cut: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 if the score is at least ``cut``)."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    if model.net is None:
        out = docs.select(*kept, F.lit(float(model.base)).alias("score"))
    else:
        out = docs.select(*kept, summaries(docs, model.net).alias("__s"))
        z = sum((F.col("__s")[i] * float(model.combine[i]) for i in range(1, 4)), F.col("__s")[0] * float(model.combine[0]))
        out = out.withColumn("score", 1 / (1 + F.exp(-z))).drop("__s")
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
