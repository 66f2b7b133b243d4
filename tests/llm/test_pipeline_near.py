"""The near-dedup stage of the pipeline: five words, similarity 0.8 or more."""

import random

import corpus_pipeline
from tests.llm.helpers import components, sentence

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [f"{sentence(rng, 1)}{rng.randrange(10**6)}" for _ in range(n)]


def test_stage_links_five_word_shingles_at_080(spark):
    rng = random.Random(5)
    rows = []
    for k in range(30):
        w = words(rng, 200)
        rows.append((10 * k, " ".join(w)))
        # A block appended: similarity 0.80 to 0.85 with either shingle size.
        rows.append((10 * k + 1, " ".join(w + words(rng, rng.randrange(38, 49)))))
        # Scattered edits: above 0.85 with three words, below 0.8 with five.
        v = list(w)
        for at in (25, 75, 125, 175, 195):
            v[at] = f"new{rng.randrange(10**6)}"
        rows.append((10 * k + 2, " ".join(v)))
    want, other = components(rows, 5, 80), components(rows, 3, 85)
    kept = {d for d, c in want.items() if d == c}
    assert kept != {d for d, c in other.items() if d == c} and 30 <= len(kept) < 90
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], DOCS)
    got = corpus_pipeline.near_dup_stage(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(kept)
