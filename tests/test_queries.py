"""Registered queries against their SQL on the provided tables.

A cross-section runs by default; CLICKLOOM_ALL_QUERIES=1 runs every one.
"""

import os

import compare
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()
SAMPLE = (
    "s6_union_of_headers", "s13_zone_routing", "p12_staged_projection", "c1_channel_rules_a", "c2_channel_rules_b",
    "f9_first_truthy_of_three", "w1_previous_event", "w6_day_over_day", "a1_session_facts", "a4_session_facts_b",
    "a8_exact_duplicates", "j1_fact_attribution", "j3_fact_attribution_b", "v8_earliest_per_transaction",
    "q7_dq_report_with_errors", "q8_dq_report", "r0_contract_violations", "m10_status_per_day",
    "tz_validation_summary", "m11_monitor_latest_day", "x10_gold_after_write_back", "x10_gold_after_write_back_b",
    "d1a_revenue_drops", "n3_attribution_coverage", "st2_streaming_sessions",
)
CHOSEN = sorted(QUERIES) if os.environ.get("CLICKLOOM_ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def db(sf_dir):
    return compare.connect(sf_dir)


def test_every_comparison_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES) and set(SAMPLE) <= set(QUERIES)


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, sf_dir, db, name):
    if name in SQL:
        assert compare.difference(spark, sf_dir, db, QUERIES[name], SQL[name]) is None
    else:
        assert QUERIES[name](spark, sf_dir).count() >= 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert result.columns[:3] == ["transaction_id", "user_id", "revenue"]
