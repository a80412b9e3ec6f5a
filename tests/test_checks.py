"""The registry's contract, and a sample of checks on the smallest data; ``python -m checks.runner`` runs them all."""

import os

import pytest

import __spark_entry__ as driver
from checks.registry import CHECKS
from checks.runner import compare, oracle_connection

SF = os.environ.get("CHECKS_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = ("day_cohort_summary", "summary_across_cutoff", "variable_pivot", "task_fact", "periodic_measures",
          "reconciliation_report", "missing_keys", "monthly_report", "bitmap_state_counts", "affected_periods")

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


def test_names_are_unique_and_every_query_has_sql():
    names = [c.name for c in CHECKS]
    assert len(names) == len(set(names))
    # The subpackage llm adds its own queries, not all of which SQL can express; its tests cover those.
    assert not set(names) & set(driver.LLM_QUERIES) and set(driver.LLM_SQL) <= set(driver.LLM_QUERIES)
    assert set(driver.queries()) - set(driver.LLM_QUERIES) == set(names) == set(driver.oracle_sql()) - set(driver.LLM_SQL)


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_check_agrees_with_sql(spark, name):
    check = next(c for c in CHECKS if c.name == name)
    state, note = compare(spark, oracle_connection(SF), SF, check)
    assert state == "ok", note


@needs_data
def test_entry_returns_rows(spark):
    assert driver.entry(spark).count() > 0
