"""The registered queries against DuckDB at the smallest scale, and their plans."""

import pytest

import __spark_entry__ as contract
import check
from topicpulse.catalog.oracle import ORACLE
from topicpulse.catalog.registry import QUERIES

SF = "/root/testdata/sf0.001"
QUICK = ("emerging_terms emergence_backfill strip_html clean_news tokens publication_times theme_of_article "
         "lexicon_sentiment term_mode_label term_sources filtered_topics filter_options day_over_day").split()


@pytest.fixture(scope="module")
def con():
    return check.oracle_connection(SF)


@pytest.mark.parametrize("name", QUICK)
def test_equals_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["termo", "data", "frequencia", "z_score", "emergente"] and df.count() > 0


@pytest.mark.parametrize("name", ["emerging_terms", "tfidf_corpus", "topic_table", "insights", "kpis"])
def test_plans_hold_no_cross_join(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = contract.queries()["baseline"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,props:string>" in plan
