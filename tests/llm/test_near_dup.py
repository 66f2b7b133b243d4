import random

import pytest

from folio.llm import near_dup
from folio.llm.common import Stages
from folio.llm.graph import connected_components
from tests.llm.helpers import components, crowded, frame, sentence, shingles


def edited(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = "new" + str(rng.randrange(10**6))
    return " ".join(w)


def corpus(seed=3, hot=60):
    rng = random.Random(seed)
    base = sentence(rng, 120)
    rows = [(i, edited(rng, base, rng.choice([1, 2, 4, 8, 20]))) for i in range(hot)]  # one hot group
    rows += [(100 + i, base) for i in range(20)]  # exact copies
    for k in range(15):
        text = sentence(rng, rng.choice([3, 12, 60]))
        rows += [(200 + 3 * k, text), (201 + 3 * k, edited(rng, text, 1)), (202 + 3 * k, text.upper())]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one"), (304, "ONE"), (305, "one two"), (306, "É two"), (307, "é two")]
    rng.shuffle(rows)
    return rows


def check(got, rows):
    want = components(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(shingles(t, 3)) for d, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_components_equal_brute_force_with_a_hot_group(spark):
    rows = corpus()
    check(near_dup.near_duplicates(frame(spark, rows)).collect(), rows)


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 9)
    rows = corpus(seed=8, hot=50)
    check(near_dup.near_duplicates(crowded(spark, rows)).collect(), rows)


def test_shuffled_id_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", -1)
    rows = corpus(seed=4, hot=20)
    check(near_dup.near_duplicates(frame(spark, rows)).collect(), rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rng = random.Random(1)
    text, other = sentence(rng, 40), sentence(rng, 40)
    rows = [(5, text), (5, text), (None, text), (None, other), (9, None), (7, text)]
    got = near_dup.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == 6
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [
        (-1, -1, True), (-1, 5, False), (5, 5, True), (5, 5, True), (7, 5, False), (9, 9, True)]
    kept = near_dup.keep_one(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, -1, 5, 9]
    assert near_dup.near_duplicates(frame(spark, [])).collect() == []


def test_a_text_of_many_words(spark):
    rng = random.Random(2)
    long = sentence(rng, 60_000)
    rows = [(1, long), (2, edited(rng, long, 200)), (3, long + " end")]
    check(near_dup.near_duplicates(frame(spark, rows)).collect(), rows)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(5, i) for i in range(6, 30)] + [(40, 41), (41, 40), (41, 30)]])
def test_components_of_a_graph(spark, edges):
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Stages(spark, "t")).collect()
    up = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in edges:
        for a, b in edges:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
    assert sorted((r.node, r.component) for r in got) == sorted(up.items())
