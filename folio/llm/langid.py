"""Language identification by a byte convolutional network.

A numpy network (embedded bytes, filters of widths 2 to 5, max pooling,
softmax) is trained on fixed-length windows of labelled texts and applied to
every window of every whole text, in Arrow batches inside Spark tasks.  The
window logits of a text are averaged, weighted by the bytes in each window.

Training rows are a bounded sample: per label the ``per_label`` rows with the
smallest hash of doc_id, and from each at most ``windows_per_text`` windows
spread over the whole text.  Any number of labels is learned; beyond
``FULL_LABELS`` of them each has a smaller share of the same sample, one row
at least.  Prediction covers all rows and all bytes.

Defined results: a null text, or one without a letter, is ``und`` with score
0; extra columns are ignored; a missing or blank label is not learned from;
rows without doc_id are predicted like
others but not learned from.  With no labelled row (or an
empty table) every prediction is ``und``.  Ties go to the label first in
order.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import bytecnn
from folio.llm.common import Stages, broadcast_if_small, map_column, map_text, row_chunks, text_bytes

LENGTH = 256
PER_LABEL = 800
WINDOWS_PER_TEXT = 3
FULL_LABELS = 500
BROADCAST_LABELS = 1_000_000
STEPS = 600
UNDETERMINED = "und"


def fold_case(data: np.ndarray) -> np.ndarray:
    """A-Z and the two-byte Latin capitals xC3 x80-x9E to lower case, so that
    text in capitals meets the same filters."""
    out = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    return out + np.where(second, 32, 0).astype(np.uint8)


def sample_labelled(docs: DataFrame, label: str, per_label: int) -> DataFrame:
    """Per label about the ``per_label`` rows with the smallest hash of doc_id
    (rows that share a doc_id stay together; rows without one are left out).

    Labels are counted first, which gives a hash below which twice as many
    rows are expected; only those are ranked, so no task sees a whole label.
    Counts and cuts are stage tables joined to the rows, so any number of
    labels will do.  Texts are read for the chosen rows only."""
    st = Stages(docs.sparkSession, "sample")
    h = F.xxhash64(F.col("doc_id").cast("string"))
    docs = docs.filter(F.col("doc_id").isNotNull())
    counts = st.put(docs.groupBy(F.col(label).alias("__label")).agg(F.count("*").alias("n")), "counts")
    n = counts.count()
    if n > FULL_LABELS:
        per_label = max(1, per_label * FULL_LABELS // n)

    def below(cuts: DataFrame) -> DataFrame:
        cuts = broadcast_if_small(cuts, n, BROADCAST_LABELS)
        return docs.join(cuts, (F.col(label) == F.col("__label")) & (h <= F.col("__most")), "left_semi")

    # 2**64 * 2 * per_label / n - 2**63 as a decimal, within the longs.
    most = F.floor(F.lit(Decimal(2**65 * per_label)).cast("decimal(30,0)") / F.col("n").cast("decimal(19,0)")) - F.lit(Decimal(2**63))
    first = counts.select("__label", F.when(F.col("n") <= 2 * per_label, F.lit(2**63 - 1)).otherwise(most.cast("long")).alias("__most"))
    ranks = below(first).select(F.col(label).alias("__label"), h.alias("h")).withColumn(
        "r", F.row_number().over(Window.partitionBy("__label").orderBy("h"))).filter(F.col("r") <= per_label)
    return below(st.put(ranks.groupBy("__label").agg(F.max("h").alias("__most")), "cuts"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> DataFrame:
    """doc_id, text and label of the sampled rows of ``labels`` (a table of
    doc_id and label; repeated rows count once).  Only ids and labels are
    ranked; the sample is bounded, so it is broadcast to the texts."""
    ids = sample_labelled(labels.select(F.col("doc_id").cast("long"), label).distinct(), label, per_label)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.join(F.broadcast(ids), "doc_id")


def training_windows(rows: DataFrame, label: str, length: int, stride: int, per_text: int, fold=lambda data: data) -> tuple[np.ndarray, list]:
    """At most ``per_text`` windows of every row, spread over its whole text,
    cut on the executors and collected (bounded by the sample)."""

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("text"))
        x, owner, filled = bytecnn.windows(fold(data), offs, length, stride)
        count = np.bincount(owner, minlength=batch.num_rows)
        first = np.cumsum(count) - count
        at = np.unique(np.concatenate([first + (count - 1) * k // max(1, per_text - 1) for k in range(per_text)]))
        raw = [bytes(x[i, :filled[i]].astype(np.uint8)) if offs[owner[i] + 1] > offs[owner[i]] else b"" for i in at]
        yield pa.RecordBatch.from_arrays([batch.column("label").take(pa.array(owner[at])), pa.array(raw, pa.binary())], names=["label", "raw"])

    kind = rows.schema[label].dataType.simpleString()
    got = map_text(rows.select(F.col(label).alias("label"), F.col("text").cast("string")), fn, f"label {kind}, raw binary")
    got = got.orderBy("label", "raw").toPandas()
    x = np.full((len(got), length), bytecnn.PAD, np.int16)
    for i, raw in enumerate(got["raw"]):
        x[i, :len(raw)] = np.frombuffer(bytes(raw), np.uint8)
    return x, got["label"].tolist()


class LanguageModel:
    """Network and its labels; ``predict`` is applied in Spark tasks."""

    def __init__(self, net: dict | None, labels: list[str], length: int):
        self.net, self.labels, self.length = net, labels, length


def fit(docs: DataFrame, label: str = "lang", length: int = LENGTH, per_label: int = PER_LABEL,
        per_text: int = WINDOWS_PER_TEXT, steps: int = STEPS) -> LanguageModel:
    """Train on the rows of ``docs`` that have a label and a letter."""
    known = docs.filter((F.length(F.trim(F.col(label))) > 0) & F.col("text").rlike(r"\p{L}"))
    x, y = training_windows(sample_labelled(known, label, per_label), label, length, length, per_text, fold_case)
    labels = sorted(set(y))
    if not labels:
        return LanguageModel(None, [], length)
    at = {v: i for i, v in enumerate(labels)}
    return LanguageModel(bytecnn.train(x, np.array([at[v] for v in y]), len(labels), steps), labels, length)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (probability of that label)."""
    made = ("lang_pred", "score")
    kept = [c for c in docs.columns if c not in made]
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if model.net is None:
        return docs.select(*kept, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    model_ = docs.sparkSession.sparkContext.broadcast((model.net, model.labels, model.length))

    def best(texts: pa.Array) -> pa.Array:
        net, labels, length = model_.value
        data, offs = text_bytes(texts)
        at, top = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for lo, hi in row_chunks(offs, 1 << 18):
            x, owner, filled = bytecnn.windows(fold_case(data[offs[lo]:offs[hi]]), offs[lo:hi + 1] - offs[lo], length, length)
            z = np.zeros((hi - lo, len(labels)))
            np.add.at(z, owner, bytecnn.logits(net, x) * filled[:, None])
            probs = bytecnn.softmax(z / np.bincount(owner, weights=filled)[:, None])
            at[lo:hi], top[lo:hi] = probs.argmax(axis=1), probs.max(axis=1)
        return pa.StructArray.from_arrays([pa.array([labels[i] for i in at], pa.string()), pa.array(top, pa.float64())],
                                          names=["lang_pred", "score"])

    out = docs.select(*kept, letters.alias("__letters"), map_column(docs.sparkSession, best, "struct<lang_pred:string,score:double>", F.col(text)).alias("__best"))
    return out.select(*kept, F.when(F.col("__letters"), F.col("__best.lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
                      F.when(F.col("__letters"), F.col("__best.score")).otherwise(0.0).alias("score"))
