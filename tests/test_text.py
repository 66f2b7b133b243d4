"""Edge cases of the column builders."""

import hashlib

from pyspark.sql import functions as F

from folio.functions import (
    book_key,
    clean_sentinel,
    clean_whitespace,
    coerce_numeric,
    cover_url,
    display_list,
    fill_display,
    integer_affinity,
    lists_to_json,
    normalize_isbn,
    normalize_text,
    null_out_of_range,
    null_tokens,
    record_id,
    stringify,
)


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_normalize_text_whitespace_classes(spark):
    values = ["  A  B\tC  ", "x\u001cy", "Tab Em", "　lead", None, "   ", "É Été"]
    out = col_values(spark, values, normalize_text)
    assert out == ["a b c", "x y", "tab em", "lead", None, "", "é été"]
    # Python's definition of whitespace is the contract.
    for v, o in zip(values, out):
        if v is not None:
            assert o == " ".join(v.strip().lower().split())


def test_clean_whitespace_keeps_case(spark):
    out = col_values(spark, ["  Hello   World ", "", None, "   "], clean_whitespace)
    assert out == ["Hello World", None, None, ""]


def test_normalize_isbn(spark):
    values = ["0-306-40615-2", "978 0 306 40615 7", "080442957x", "12-34", "", None, "ISBN 0306406152"]
    out = col_values(spark, values, normalize_isbn)
    assert out == ["0306406152", "9780306406157", "080442957X", None, None, None, "0306406152"]


def test_year_coercion_and_bounds(spark):
    values = ["1499", "1500", "2035", "2036", "n.d.", "1999d", " 1999 ", "nan", "Infinity", "1.5e3", None]
    out = col_values(spark, values, lambda c: null_out_of_range(coerce_numeric(c, "string"), 1500, 2035))
    assert out == [None, 1500.0, 2035.0, None, None, None, 1999.0, None, None, 1500.0, None]


def test_stringify_strips_only_ends(spark):
    assert col_values(spark, ["  978 0 ", None], stringify) == ["978 0", None]


def test_na_tokens(spark):
    out = col_values(spark, ["NA", "nan", "null", "None", "", "N/A", "value", "  "], null_tokens)
    assert out == [None, None, None, None, None, None, "value", "  "]


def test_record_id_matches_md5_with_empty_for_null(spark):
    df = spark.createDataFrame([("t", None, "123")], "title string, author_editor string, isbn string")
    got = df.select(record_id()).first()[0]
    assert got == hashlib.md5("t||123".encode()).hexdigest()


def test_book_key(spark):
    df = spark.createDataFrame([(None, "Some Title"), ("0306406152", "X")], "isbn string, title string")
    assert [r[0] for r in df.select(book_key()).collect()] == ["NOISBN|some title", "0306406152|x"]


def test_sentinels_and_display(spark):
    assert col_values(spark, [" null ", "None", "", " x ", "\tNULL\n", "\u00a0v w\n"], clean_sentinel) == [
        None, None, None, "x", None, "v w"]
    values = ['["a", "b"]', "['a', 'b']", "[broken", "plain", None, "[1, 2]", '["a", null]', "[true]", "[]"]
    out = col_values(spark, values, display_list)
    assert out == ["a, b", "a, b", "[broken", "plain", None, "[1, 2]", '["a", null]', "[true]", ""]


def test_lists_to_json_and_cover(spark):
    df = spark.createDataFrame([(["a", "b"], "123"), (None, None)], "a array<string>, isbn string")
    rows = df.select(lists_to_json("a"), cover_url("isbn")).collect()
    assert rows[0][0] == '["a","b"]' and rows[0][1].endswith("/123-L.jpg")
    assert rows[1][0] is None and rows[1][1] is None


def test_fill_display_and_integer_affinity(spark):
    assert col_values(spark, ["", None, "x"], lambda c: fill_display(c, "Untitled")) == ["Untitled", "Untitled", "x"]
    assert col_values(spark, ["200", " 12 ", "xii", "1.5", None], integer_affinity) == [200, 12, None, None, None]
