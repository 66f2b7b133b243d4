"""Physical-plan properties the design relies on."""

from conftest import SF_ORACLE, plan_text

import __spark_entry__ as E


def tree(df):
    """Operators of the physical plan, top first."""
    lines = plan_text(df, "simple").splitlines()
    return [line.strip(" +-:*()0123456789") for line in lines if line.strip()]


def scans(df):
    return [line for line in plan_text(df).splitlines() if line.startswith("ReadSchema")]


def test_keep_first_pre_aggregates_before_shuffle(spark):
    nodes = tree(E.queries()["keep_first_lineitem"](spark, SF_ORACLE))
    final = next(i for i, n in enumerate(nodes) if "functions=[min_by" in n)
    exchange = next(i for i, n in enumerate(nodes) if n.startswith("Exchange"))
    partial = next(i for i, n in enumerate(nodes) if "functions=[partial_min_by" in n)
    assert final < exchange < partial


def test_texts_are_not_read_where_they_are_not_returned(spark):
    for name in ("tiered_enrichment", "enrichment_stats", "lookup_isbn", "clean_profile", "duplicate_titles", "resume_remaining",
                 "store_stats", "rows_removed", "cover_url"):
        found = scans(E.queries()[name](spark, SF_ORACLE))
        assert found and not [s for s in found if "text:" in s], name


def test_lookup_by_isbn_filters_before_the_dedupe(spark):
    nodes = tree(E.queries()["lookup_isbn"](spark, SF_ORACLE))
    partial = next(i for i, n in enumerate(nodes) if "partial_min_by" in n)
    assert any(n.startswith("Filter") and "9780000000011" in n for n in nodes[partial:])


def test_metadata_is_parsed_once(spark):
    """The enrichment reads the reduced lookups from their stage tables."""
    plan = plan_text(E.queries()["tiered_enrichment"](spark, SF_ORACLE))
    assert "from_json" not in plan and "lookup-isbn" in plan and "lookup-title" in plan


def test_cleaning_stays_in_the_jvm(spark):
    plan = plan_text(E.queries()["clean_catalog"](spark, SF_ORACLE))
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert python_node not in plan


def test_scan_prunes_columns(spark):
    plan = plan_text(E.queries()["keep_first_lineitem"](spark, SF_ORACLE))
    read_schema = [line for line in plan.splitlines() if "ReadSchema" in line][0]
    assert "l_comment" not in read_schema and "l_tax" not in read_schema and "l_discount" not in read_schema


def test_recommend_broadcasts_results_at_run_time(spark):
    df = E.queries()["recommend_books"](spark, SF_ORACLE)
    df.collect()  # the final adaptive plan is known after execution
    final = plan_text(df, "simple").split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "BroadcastHashJoin" in final


def test_top_k_uses_group_limit(spark):
    plan = plan_text(E.queries()["dense_top_k"](spark, SF_ORACLE))
    assert "WindowGroupLimit" in plan and "Partial" in plan
