"""The correctness gate: every registered query equals its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from oracle import compare

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_ORACLE, QUERIES[name], ORACLES[name])
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["columns_match"], res
    assert res["values_match"], res


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
