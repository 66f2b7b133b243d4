"""Property tests: column builders and keep-first against plain Python/pandas."""

import re

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from folio.functions import normalize_isbn, normalize_text
from folio.operators.cleaning import dedupe_catalog

WHITESPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0        　"
texts = st.text(alphabet=st.sampled_from(list("aAbBéÉx1X-0 ") + list(WHITESPACE)), max_size=20)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def py_normalize(v):
    return None if v is None else re.sub(r"\s+", " ", v.strip().lower())


def py_isbn(v):
    if v is None:
        return None
    s = re.sub(r"[^0-9Xx]", "", v).upper()
    return s if len(s) in (10, 13) else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=40))
def test_text_builders_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", normalize_text("v").alias("n"), normalize_isbn("v").alias("b")).orderBy("i").collect()
    assert [r["n"] for r in rows] == [py_normalize(v) for v in values]
    assert [r["b"] for r in rows] == [py_isbn(v) for v in values]


keys = st.sampled_from(["a", "b", "c", None])


@SETTINGS
@given(st.lists(st.tuples(keys, keys, st.sampled_from(["0306406152", "9780306406157", None])), min_size=1, max_size=60))
def test_two_tier_dedupe_matches_pandas(spark, rows):
    data = [(i, t, a, isbn) for i, (t, a, isbn) in enumerate(rows)]
    pdf = pd.DataFrame(data, columns=["row_pos", "title", "author_editor", "isbn"])
    with_isbn = pdf[pdf["isbn"].notna()].drop_duplicates(subset=["isbn"], keep="first")
    without = pdf[pdf["isbn"].isna()].drop_duplicates(subset=["title", "author_editor"], keep="first")
    expected = sorted(pd.concat([with_isbn, without])["row_pos"].tolist())
    df = spark.createDataFrame(data, "row_pos int, title string, author_editor string, isbn string").repartition(3)
    got = sorted(r["row_pos"] for r in dedupe_catalog(df).collect())
    assert got == expected
