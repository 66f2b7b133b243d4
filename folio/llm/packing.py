"""Packing of token pieces into sequences as a cutting-stock problem.

Method
  1. Texts are tokenized in Spark tasks; id 0 ends each document.  A document
     is cut into full pieces and a remainder shorter than a sequence.
  2. Only the histogram of piece lengths (at most ``size`` rows) reaches the
     driver.  There the cutting-stock linear program is solved by column
     generation: columns are patterns (how many pieces of each length fill
     one sequence), a knapsack dynamic program over the dual prices finds the
     best new column, and the program stops when the Farley bound proves the
     solution within ``gap`` of the optimum, or that no whole sequence can be
     saved (or, with a warning that names the bound, after ``MOST_ROUNDS``).  The first basis takes knapsack
     patterns of the lengths that are left, each until one is used up.
     Levels are rounded down; the few pieces left over are packed by a greedy
     run or first fit, whichever takes fewer sequences (and a small histogram
     by first fit alone, should rounding cost more than that).
  3. Pieces are ranked within their length (bucket counts and offsets, no
     global sort); rank r of a length takes slot r of the patterns' slots
     for it, which names its sequence and offset.

Ids are those of the ``tokenizers`` library on the given vocabulary file with
``add_special_tokens=False``: none is added, and the string of an added token
in a text is that token.  They are computed by ``tiktoken`` on the ranks of
the same file, about four times as fast, after a probe that both give the same
ids; texts are split at added tokens first.  A text on which ``tiktoken``
raises (a run of over a million spaces exceeds its regex stack), and any text
if added tokens strip or need word edges, is encoded by ``tokenizers``.

Defined results: a null or empty text is the single id 0.  Repeated rows and
repeated doc_ids are packed one by one; rows without doc_id are packed.
Extra columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

import json
import logging
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import Stages, map_text

SIZE = 1024
GAP = 2e-4
BUCKET_ROWS = 50_000
#: Path of the vocabulary file that the registered queries use.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MOST_ROUNDS = 2_000

_ENCODERS: dict[str, object] = {}
PROBE = "It's 3.14 km, naïve ÉÀ  tabs\t\tand\n\nlines…   end 12345 #!?  日本 "


def load_encoder(path: str):
    """``text -> uint32 ids`` for a byte-level BPE vocabulary file."""
    if path not in _ENCODERS:
        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        # Byte-level files write byte b as a printable character.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        char = {chr(b): b for b in plain}
        char.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
        ranks = {bytes(char[c] for c in token): i for token, i in vocab.items() if all(c in char for c in token)}
        added = {t.content: (i, t) for i, t in slow.get_added_tokens_decoder().items()}
        ranks = {t: i for t, i in ranks.items() if t.decode("utf-8", "replace") not in added}
        fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        # The longest of the added tokens that start at a place is taken.
        mark = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

        def exact(text: str) -> np.ndarray:
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

        def split(text: str) -> np.ndarray:
            try:
                found = list(mark.finditer(text)) if mark else []
                if not found:
                    return fast.encode_to_numpy(text, disallowed_special=())
                parts, at = [], 0
                for m in found:
                    parts += [fast.encode_to_numpy(text[at:m.start()], disallowed_special=()), np.array([added[m[0]][0]], np.uint32)]
                    at = m.end()
                return np.concatenate([*parts, fast.encode_to_numpy(text[at:], disallowed_special=())])
            except ValueError:
                return exact(text)

        whole = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for _, t in added.values())
        probe = PROBE + "".join(f"{t} b" for t in added)
        _ENCODERS[path] = split if whole and split(probe).tolist() == exact(probe).tolist() else exact
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = SIZE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece."""

    def fn(batch: pa.RecordBatch):
        encode = load_encoder(tokenizer_path)
        row, start, length, crc, total = [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            ids = np.append(encode(text) if text else np.zeros(0, np.uint32), 0).astype("<u4")
            for a in range(0, len(ids), size):
                part = ids[a:a + size]
                row.append(i)
                start.append(a)
                length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
                total.append(len(ids))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fn,
                    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def knapsack(lengths: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for every capacity up to ``size`` with any number of copies,
    and the length taken last (index; -1: stop)."""
    best = np.zeros(size + 1)
    last = np.full(size + 1, -1)
    for c in range(1, size + 1):
        n = int(np.searchsorted(lengths, c, side="right"))
        if n:
            got = best[c - lengths[:n]] + value[:n]
            k = int(got.argmax())
            if got[k] > best[c] + 1e-12:
                best[c], last[c] = got[k], k
        if best[c - 1] > best[c]:
            best[c], last[c] = best[c - 1], -2  # leave one unit empty
    return best, last


def read_pattern(lengths: np.ndarray, last: np.ndarray, size: int) -> dict[int, int]:
    out: dict[int, int] = {}
    c = size
    while c > 0 and last[c] != -1:
        if last[c] == -2:
            c -= 1
            continue
        k = int(last[c])
        out[k] = out.get(k, 0) + 1
        c -= int(lengths[k])
    return out


def greedy(lengths: np.ndarray, need: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns with whole multiplicities that use up ``need``: knapsack
    patterns of what is left (long pieces preferred), each repeated until one
    of its lengths runs out."""
    need = need.copy()
    value = lengths * (1 + 0.05 * lengths / size)
    out = []
    while need.any():
        here = np.flatnonzero(need)
        _, last = knapsack(lengths[here], value[here], size)
        pattern: dict[int, int] = {}
        room, c = size, size
        while c > 0 and last[c] != -1:
            if last[c] == -2:
                c -= 1
                continue
            k = int(here[last[c]])
            if pattern.get(k, 0) < need[k]:
                pattern[k] = pattern.get(k, 0) + 1
                room -= int(lengths[k])
            c -= int(lengths[k])
        for k in here[::-1].tolist():  # fill what scarce lengths have left open
            if lengths[k] <= room:
                add = int(min(room // lengths[k], need[k] - pattern.get(k, 0)))
                if add > 0:
                    pattern[k] = pattern.get(k, 0) + add
                    room -= add * int(lengths[k])
        times = int(min(need[k] // a for k, a in pattern.items()))
        for k, a in pattern.items():
            need[k] -= a * times
        out.append((pattern, times))
    return out


def first_fit(lengths: np.ndarray, need: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns of first-fit decreasing; sequences that look alike are one
    group, so the work grows with the lengths, not with the pieces."""
    groups: list[list] = []  # room, pattern, how many
    for k in range(len(lengths) - 1, -1, -1):
        v, n = int(lengths[k]), int(need[k])
        opened = []
        for room, pattern, times in groups:
            fit = min(room // v, n) if n else 0
            if fit:
                full = min(times, n // fit)
                n -= full * fit
                opened.append([room - fit * v, pattern | {k: fit}, full])
                if full < times and n and n < fit:
                    opened.append([room - n * v, pattern | {k: n}, 1])
                    full, n = full + 1, 0
                times -= full
            if times:
                opened.append([room, pattern, times])
        each = size // v
        if n // each:
            opened.append([size - each * v, {k: each}, n // each])
        if n % each:
            opened.append([size - n % each * v, {k: n % each}, 1])
        groups = opened
    return [(pattern, times) for _, pattern, times in groups]


def first_basis(lengths: np.ndarray, need: np.ndarray, size: int) -> tuple[list[dict[int, int]], np.ndarray]:
    """A feasible basis: knapsack patterns of the lengths left, each at the
    (fractional) level that uses up one of them, which it is the column of.
    Later patterns lack that length, so the basis is triangular."""
    left = need.astype(float)
    value = lengths * (1 + 0.05 * lengths / size)
    basis: list[dict[int, int]] = [{} for _ in lengths]
    level = np.zeros(len(lengths))
    open_ = np.ones(len(lengths), bool)
    while open_.any():
        here = np.flatnonzero(open_)
        _, last = knapsack(lengths[here], value[here], size)
        pattern = {int(here[k]): a for k, a in read_pattern(lengths[here], last, size).items()}
        k = min(pattern, key=lambda j: (left[j] / pattern[j], j))
        basis[k], level[k] = pattern, left[k] / pattern[k]
        for j, a in pattern.items():
            left[j] = max(0.0, left[j] - a * level[k])
        open_[k] = False
    return basis, level


def solve_patterns(lengths: np.ndarray, need: np.ndarray, size: int, gap: float = GAP, stats: dict | None = None) -> list[tuple[dict[int, int], int]]:
    """Patterns and multiplicities that pack every piece: the linear program
    by column generation, rounded down, and the rest on top.  ``stats`` takes
    the rounds, the program's objective and the proven bound."""
    basis, x = first_basis(lengths, need, size)
    rhs = need.astype(float)
    bound = float(need @ lengths) / size

    def column(pattern: dict[int, int]) -> np.ndarray:
        col = np.zeros(len(lengths))
        for k, a in pattern.items():
            col[k] = a
        return col

    inv = np.linalg.inv(np.stack([column(p) for p in basis], axis=1))
    for step in range(1, MOST_ROUNDS + 1):
        price = inv.sum(axis=0)  # every sequence costs one; negative for a length that only gets in the way
        best, last = knapsack(lengths, price, size)
        bound = max(bound, float(price @ rhs) / max(1.0, best[size]))
        if x.sum() <= bound * (1 + gap) or np.ceil(x.sum() - 1e-6) <= np.ceil(bound - 1e-6) or best[size] <= 1 + 1e-9:
            break
        enter = read_pattern(lengths, last, size)
        move = inv @ column(enter)
        up = move > 1e-9
        if not up.any():
            break
        ratio = np.full(len(x), np.inf)
        ratio[up] = np.maximum(x[up], 0) / move[up]
        # Of equal ratios the largest step in the entering column: no cycle of
        # steps of length zero on rounding errors.
        near = ratio <= ratio.min() + 1e-9
        out = int(np.where(near, move, -np.inf).argmax())
        x -= ratio[out] * move
        x[out] = ratio[out]
        basis[out] = enter
        pivot = inv[out] / move[out]
        inv -= np.outer(move, pivot)
        inv[out] = pivot
        if step % 200 == 0:  # keep rounding errors small
            inv = np.linalg.inv(np.stack([column(p) for p in basis], axis=1))
            x = inv @ rhs
    else:
        # Still a whole packing; with many lengths of a few pieces each the
        # last steps towards the optimum are very small.
        logging.getLogger(__name__).warning("column generation stopped after %d rounds at %.2f sequences, proven bound %.2f", MOST_ROUNDS, x.sum(), bound)
    if stats is not None:
        stats.update(rounds=step, objective=float(x.sum()), bound=bound)
    left = need.copy()
    whole = []
    for pattern, level in zip(basis, x):
        times = int(min([np.floor(level + 1e-6), *(left[k] // a for k, a in pattern.items())]))
        if times > 0:
            for k, a in pattern.items():
                left[k] -= a * times
            whole.append((pattern, times))
    # What rounding down leaves, in the better of two ways.  On a few dozen
    # pieces rounding can cost more than first fit does in all.
    ways = [whole + greedy(lengths, left, size), whole + first_fit(lengths, left, size), first_fit(lengths, need, size)]
    return min(ways, key=lambda way: sum(times for _, times in way))


def slots(lengths: np.ndarray, patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, copies, first sequence, offset) of its
    slots, by rank."""
    rows: dict[int, list] = {int(v): [] for v in lengths}
    next_rank = {int(v): 0 for v in lengths}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for k, copies in sorted(pattern.items(), reverse=True):
            v = int(lengths[k])
            rows[v].append((next_rank[v], copies, sequence, offset))
            next_rank[v] += copies * times
            offset += copies * v
        sequence += times
    return {v: np.array(r, np.int64) for v, r in rows.items() if r}


def ranked(pieces: DataFrame, n: int, stages: Stages) -> DataFrame:
    """``rank`` of every piece within its length: buckets are counted, then
    numbered, so no length is ever sorted in one task."""
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    cut = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(max(1, -(-n // BUCKET_ROWS)))))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = stages.put(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", before.alias("base")), "counts")
    local = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    return cut.withColumn("local", local).join(counts, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("local")).drop("bucket", "local", "base")


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, gap: float = GAP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    spark = docs.sparkSession
    st = Stages(spark, "packing")
    pieces = st.put(token_pieces(docs, tokenizer_path, size), "pieces")
    histogram = sorted((r["length"], r["count"]) for r in pieces.groupBy("length").count().collect())  # at most `size` rows
    full = dict(histogram).get(size, 0)
    part = [(v, c) for v, c in histogram if v < size]
    lengths = np.array([v for v, _ in part], np.int64)
    patterns = solve_patterns(lengths, np.array([c for _, c in part], np.int64), size, gap) if part else []
    table = slots(lengths, patterns)
    if full:
        table[size] = np.array([(0, 1, sum(t for _, t in patterns), 0)], np.int64)
    plan = spark.sparkContext.broadcast(table)

    def fn(batch: pa.RecordBatch):
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for v in np.unique(length):
            at = np.flatnonzero(length == v)
            rows = plan.value[int(v)]
            r = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
            k = rank[at] - r[:, 0]
            seq[at] = r[:, 2] + k // r[:, 1]
            off[at] = r[:, 3] + k % r[:, 1] * v
        cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(seq), pa.array(off)],
                                         names=[*cols, "sequence_id", "offset"])

    return map_text(ranked(pieces, sum(c for _, c in histogram), st), fn,
                    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
