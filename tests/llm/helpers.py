"""Small inputs and brute-force versions for the operator tests."""

from __future__ import annotations

import collections
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Columns beside doc_id and text, with names the operators use inside.
EXTRA = "doc_id long, text string, lang string, spans string, score string, kept string, runs int, node int, h int, bucket int, label string, width int"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def crowded(spark, rows):
    """The same rows with many further columns of clashing names."""
    return spark.createDataFrame([(d, t, "en", "x", "y", "z", 1, 2, 3, 4, "l", 5) for d, t in rows], EXTRA)


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(words))


def shingles(text: str | None, size: int) -> frozenset:
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = WORD.findall(low)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def components(rows, size=3, percent=85):
    """doc_id -> smallest linked doc_id, comparing all pairs."""
    sets = [(d, shingles(t, size)) for d, t in rows]
    up = {d: d for d, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            n = len(s & t)
            if s and t and 100 * n >= percent * (len(s) + len(t) - n):
                ra, rb = root(a), root(b)
                up[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d, _ in rows}


def cut_repeats(texts: list[str | None], length: int) -> list[tuple[int, int, bytes]]:
    """(removed bytes, removed runs, bytes left) of every text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        mask = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                mask[i:i + length] = [True] * length
        runs = sum(m and not p for m, p in zip(mask, [False, *mask]))
        out.append((sum(mask), runs, bytes(c for c, m in zip(b, mask) if not m)))
    return out
