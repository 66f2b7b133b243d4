"""Feature table: list flattening, signal extraction, frozen columns."""

from folio.operators.features import ensure_columns, features, flatten_struct, join_lists, select_frozen


def test_features_with_signals_struct(spark):
    df = spark.createDataFrame(
        [("r1", "T", "c", ("learn", "deep"), "P", "100", ["a", "b"]), ("r2", "U", None, None, None, None, None)],
        "record_id string, title string, class_no_book_no string, signals struct<intent:string, depth:string>, "
        "publisher string, pages string, authors array<string>",
    )
    out = {r["record_id"]: r for r in features(df).collect()}
    assert features(df).columns == ["record_id", "title", "class_no_book_no", "intent", "depth", "publisher", "pages"]
    assert (out["r1"]["intent"], out["r1"]["depth"]) == ("learn", "deep")
    assert out["r2"]["intent"] is None and out["r2"]["depth"] is None


def test_features_signals_absent_or_json(spark):
    df = spark.createDataFrame([("r1", '{"intent": "x"}')], "record_id string, signals string")
    r = flatten_struct(df, "signals", ["intent", "depth"]).first()
    assert r["intent"] == "x" and r["depth"] is None
    r = select_frozen(spark.createDataFrame([("r1",)], "record_id string")).first()
    assert r.asDict() == {c: (None if c != "record_id" else "r1") for c in
                          ["record_id", "title", "class_no_book_no", "intent", "depth", "publisher", "pages"]}


def test_join_lists_and_ensure_columns(spark):
    df = spark.createDataFrame([(["a", None, "b"], "not a list")], "authors array<string>, subjects string")
    r = join_lists(df).first()
    assert r["authors"] == "a, b" and r["subjects"] is None  # non-list -> NULL
    out = ensure_columns(df, {"year": "double", "authors": "string"})
    assert out.schema["year"].dataType.simpleString() == "double" and "authors" in out.columns
