"""Rows that lack or share a doc_id are judged by their own texts."""

import random

from folio.llm import decontam, near_dup
from tests.llm.helpers import components, crowded, frame, sentence
from tests.llm.test_decontam import ITEM, ITEM_SCHEMA, ITEMS
from tests.llm.test_near_dup import edited


def test_only_rows_that_hold_an_item_go(spark):
    clean = [(None, "clean too"), (None, None), (7, "an unrelated clean text"), (8, "another"), (8, "another")]
    rows = clean + [(None, ITEM), (7, ITEM), (7, "Say " + ITEM), (9, ITEM)]
    left = decontam.decontaminate(crowded(spark, rows), frame(spark, ITEMS, ITEM_SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(clean, key=str)


def test_texts_under_one_id_are_separate_nodes(spark):
    rng = random.Random(6)
    texts = [sentence(rng, 80) for _ in range(12)]
    rows = [(5, t) for t in texts] + [(5, texts[0]), (5, texts[1].upper()), (5, None), (5, "")]  # one id for a dozen texts
    rows += [(20 + i, edited(rng, t, 1)) for i, t in enumerate(texts[:6])] + [(3, edited(rng, texts[7], 1))]
    rows += [(40, sentence(rng, 50)), (None, texts[2]), (None, sentence(rng, 9))]
    got = near_dup.keep_one(crowded(spark, rows)).collect()
    # All pairs of texts, numbered; the smallest doc_id of a group stays.
    have = [(d, t) for d, t in rows if d is not None and t]
    group = components([(i, t) for i, (_, t) in enumerate(have)])
    want = sorted(min(have[i][0] for i in group if group[i] == g) for g in set(group.values()))
    assert want.count(5) == 11 and want.count(3) == 1
    assert sorted(r.doc_id for r in got if r.doc_id is not None and r.text) == want
    assert [r.doc_id for r in got if not r.text] == [5]
    assert sum(r.doc_id is None for r in got) == 2
    left = [(i, r.text) for i, r in enumerate(got) if r.doc_id is not None and r.text]
    assert all(d == c for d, c in components(left).items())
