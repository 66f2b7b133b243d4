import duckdb
import pytest

from folio.llm import decontam, queries
from tests.conftest import SF_ORACLE
from tests.llm.helpers import crowded, frame

ITEM = "A train leaves the station at 60 km per hour while Anna walks 5 miles and then 5 miles back towards Boston before the evening ends."
SHORT = "which of these is the capital"
ITEMS = [(1, ITEM), (2, SHORT), (3, "too short"), (4, None), (5, ""), (6, "Completely different words fill this other question so that nothing else will ever match it at all."), (1, ITEM)]
ITEM_SCHEMA = "item_id long, text string"


def found(spark, text, make=frame, doc_id=10):
    rows = decontam.contaminated(make(spark, [(doc_id, text)]), frame(spark, ITEMS, ITEM_SCHEMA)).collect()
    return {(r.doc_id, r.item_id): r.verbatim for r in rows}


@pytest.mark.parametrize("text,want", [
    ("Before. " + ITEM + " After it.", {(10, 1): True}),
    (ITEM.lower(), {(10, 1): True}), (ITEM.upper(), {(10, 1): True}),  # whole items are found in any case
    (ITEM.lower().replace("evening", "morning"), {}),  # but not parts of them
    (ITEM.replace("Anna", "Mary Jane").replace("Boston", "New York City"), {(10, 1): False}),  # a name is one slot
    (ITEM.replace("Boston", "Anna"), {}),  # two names became one
    (ITEM.replace("60", "75").replace("5 miles", "12 miles").replace("Anna", "Clara"), {(10, 1): False}),
    (ITEM.replace("60 km", "40 meters"), {(10, 1): False}),
    (ITEM.replace("5 miles and", "7 miles and"), {}),  # one value became two
    (ITEM.replace("60", "5"), {}),  # two values became one
    ("x " + SHORT + " y", {(10, 2): True}),
    ("too short", {}), ("", {}), (None, {}), ("clean words of a document that has nothing to do with any item", {}),
    (" ".join(["filler words"] * 20_000) + " " + ITEM, {(10, 1): True}),
])
def test_items_in_texts(spark, text, want):
    assert found(spark, text) == want


TOM = "Tom has 5 apples. Tom eats 2 apples. How many apples does Tom have?"
SUM = "What is 12 + 45 * 3?"


@pytest.mark.parametrize("text,want", [
    (TOM, {(10, 1): True}),
    ("So: " + TOM.replace("Tom", "Bob").replace("5", "9") + " Tell me.", {(10, 1): False}),  # names at the start of sentences
    (TOM.replace("Tom", "Mary Jane").replace("5", "1,250"), {(10, 1): False}),
    (TOM.replace("Tom eats", "Ann eats"), {}),  # one name became two
    (TOM.lower(), {(10, 1): True}),
    ("Tell me: what is 12+45*3 please", {(10, 2): True}),  # all but slots: exact copies
    ("What is 12 + 46 * 3?", {}),
    ("Tom has apples. How many? 12 45 3 what is", {}),
])
def test_names_at_sentence_starts_and_slot_heavy_items(spark, text, want):
    rows = decontam.contaminated(frame(spark, [(10, text)]), frame(spark, [(1, TOM), (2, SUM)], ITEM_SCHEMA)).collect()
    assert {(r.doc_id, r.item_id): r.verbatim for r in rows} == want


def test_extra_columns_null_ids_and_repeated_rows(spark):
    assert found(spark, ITEM, crowded) == {(10, 1): True}
    assert found(spark, ITEM, doc_id=None) == {(None, 1): True}
    rows = [(1, ITEM), (1, ITEM), (2, "clean text without it"), (None, "clean too"), (None, SHORT)]
    docs = frame(spark, rows)
    assert sorted((r.doc_id, r.item_id) for r in decontam.contaminated(docs, frame(spark, ITEMS, ITEM_SCHEMA)).collect() if r.doc_id) == [(1, 1)]
    left = decontam.decontaminate(crowded(spark, rows), frame(spark, ITEMS, ITEM_SCHEMA)).collect()
    assert sorted((r.doc_id for r in left), key=str) == [2, None]  # rows without an id are judged by their own texts


def test_empty_tables(spark):
    items, docs = frame(spark, ITEMS, ITEM_SCHEMA), frame(spark, [(1, ITEM)])
    assert decontam.contaminated(frame(spark, []), items).collect() == []
    assert decontam.contaminated(docs, frame(spark, [], ITEM_SCHEMA)).collect() == []
    assert decontam.decontaminate(docs, frame(spark, [], ITEM_SCHEMA)).count() == 1


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    want = found(spark, "Say: " + ITEM)
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(decontam, "BROADCAST_DOCS", -1)
    assert found(spark, "Say: " + ITEM) == want == {(10, 1): True}


def test_equals_sql_on_slots(spark, tmp_path):
    docs = [(1, ITEM), (2, ITEM.replace("60", "7.5").replace("Anna", "Maria Luisa")), (3, ITEM.replace("60 km", "1,200.5 kg")), (4, SHORT + " 3 4.5.6 Zoe"),
            (5, ITEM.replace("5 miles", "8 miles")), (6, None), (None, ITEM), (7, ITEM.upper()), (8, "If The Anna Bob And Carl Then " + ITEM),
            (9, ITEM.replace("Anna", "Eva Maria de Jong")), (11, "McDonald Iphone iPhone XY É Été " + ITEM.lower() + " A-A I. If If If")]
    got = decontam.contaminated(frame(spark, docs), frame(spark, ITEMS, ITEM_SCHEMA)).collect()
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", ITEMS)
    want = con.execute(decontam.oracle_sql()).fetchall()
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key) and len(want) >= 8


def test_main_path_is_native(spark):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        queries.op9_benchmark_decontamination(spark, SF_ORACLE).explain()
    assert "Python" not in buf.getvalue() and "Pandas" not in buf.getvalue() and "Arrow" not in buf.getvalue()
