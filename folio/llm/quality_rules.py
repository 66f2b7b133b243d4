"""Quality rules: base counts and a hashed n-gram likelihood ratio.

Words and neighbouring word pairs of a text fall into ``2**BITS`` hash
buckets.  Two multinomials over the buckets (add-one smoothed) are counted
over all trusted rows and over all rows of the corpus, pre-aggregated in
every task.  A text's score is the mean log ratio of trusted to raw
probability over its n-grams; it passes at ``threshold`` or above.  Every
document is scored whole and judged by the same fixed threshold.

Defined results: words are runs outside x20 and x09-x0D.  A null or empty
text has no words, fails the base rules and scores 0.  Repeated rows are
counted and returned one by one; rows without doc_id are scored, and trusted
only if a missing id is.  Without a trusted row the ratio is 0 for every text
(only the base rules decide).  Extra columns are ignored; an empty table
gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordhash as wh
from folio.llm.common import broadcast_if_small, map_text, release_memory, row_chunks, slices, small_batches, text_bytes

BITS = 16
THRESHOLD = -0.2
BROADCAST_IDS = 2_000_000
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def ngram_buckets(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word and every pair of neighbouring words."""
    owner = np.arange(len(rows) - 1).repeat(np.diff(rows))
    pair = wh.window_hashes(h, 2)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    shift = np.uint64(64 - BITS)
    return (np.concatenate([h >> shift, pair[inside] >> shift]).astype(np.int64), np.concatenate([owner, owner[:-1][inside] if len(owner) else owner]))


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-grams per bucket over the ids in ``trusted`` and over all of ``docs``."""
    ids = trusted.select(F.col("doc_id").alias("__t")).distinct()
    ids = broadcast_if_small(ids, ids.count(), BROADCAST_IDS)
    marked = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(ids, F.col("doc_id").eqNullSafe(F.col("__t")), "left")
              .select("text", (F.col("__t").isNotNull()).alias("trusted")))

    def run(batches):
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in (part for whole in batches for part in slices(whole)):
            data, offs = text_bytes(batch.column("text"))
            good = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi in row_chunks(offs):
                part = data[offs[lo]:offs[hi]]
                starts, ends, rows = wh.words(part, offs[lo:hi + 1] - offs[lo])
                bucket, owner = ngram_buckets(wh.word_hashes(part, starts, ends), rows)
                total[1] += np.bincount(bucket, minlength=1 << BITS)
                total[0] += np.bincount(bucket[good[lo:hi][owner]], minlength=1 << BITS)
        release_memory()
        at = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], names=["bucket", "trusted", "raw"])

    small_batches(docs.sparkSession)
    got = marked.mapInArrow(run, "bucket long, trusted long, raw long").groupBy("bucket").agg(F.sum("trusted").alias("t"), F.sum("raw").alias("r"))
    out = np.zeros((2, 1 << BITS), np.int64)
    for b, t, r in got.collect():  # at most 2**BITS rows
        out[:, b] = t, r
    return out[0], out[1]


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not trusted.any():
        return np.zeros(len(raw))
    return np.log((trusted + 1) / (trusted.sum() + len(raw))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def base_counts(text: bytes) -> tuple[int, int, int]:
    """word_chars, n_symbols and n_dup_lines need only the text's bytes."""
    b = np.frombuffer(text, np.uint8)
    chars = int(((b & 0xC0) != 0x80)[wh.WORD_BYTE[b]].sum())
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\x0b\x0c\r")] if b"\n" in text else []
    return chars, int(SYMBOL[b].sum()), len(lines) - len(set(lines))


def judge(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score and kept of every row."""
    weights = docs.sparkSession.sparkContext.broadcast(ratio)

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("text"))
        n_rows = batch.num_rows
        n_words, chars, symbols, dup, repeat = (np.zeros(n_rows, np.int64) for _ in range(5))
        score = np.zeros(n_rows)
        for lo, hi in row_chunks(offs):
            part = data[offs[lo]:offs[hi]]
            starts, ends, rows = wh.words(part, offs[lo:hi + 1] - offs[lo])
            h = wh.word_hashes(part, starts, ends)
            bucket, owner = ngram_buckets(h, rows)
            n_words[lo:hi] = np.diff(rows)
            sums = np.bincount(owner, weights=weights.value[bucket], minlength=hi - lo)
            score[lo:hi] = sums / np.maximum(1, np.bincount(owner, minlength=hi - lo))
            five = wh.window_hashes(h, 5)
            for i in range(hi - lo):
                a, b = rows[i], rows[i + 1]
                chars[lo + i], symbols[lo + i], dup[lo + i] = base_counts(part[offs[lo + i] - offs[lo]:offs[lo + i + 1] - offs[lo]].tobytes())
                if b - a >= 6:
                    w = five[a:b - 4]
                    order = np.argsort(w, kind="stable")
                    same = w[order][1:] == w[order][:-1]
                    if same.any():
                        hit = np.zeros(len(w), bool)
                        hit[order[1:][same]] = hit[order[:-1][same]] = True
                        edge = np.zeros(b - a + 1, np.int64)
                        np.add.at(edge, np.flatnonzero(hit), 1)
                        np.add.at(edge, np.flatnonzero(hit) + 5, -1)
                        repeat[lo + i] = int((np.cumsum(edge) > 0).sum())
        failed = (n_words < 10) | (100 * repeat > 20 * n_words)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c) for c in (n_words, chars, symbols, dup, repeat, failed, score, ~failed & (score >= threshold)))],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"])

    return map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fn,
                    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                    "base_failed boolean, score double, kept boolean")


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """:func:`judge` with the ratio of the ids in ``trusted`` to all rows."""
    return judge(docs, log_ratio(*bucket_counts(docs, trusted)), threshold)
