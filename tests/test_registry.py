"""A few registered queries against their SQL; the whole list is checked by ``python tests/oracle.py DIR``."""

import os

import pytest

from oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SOME = ["completeness_profile", "discovered_rules", "numeric_loose", "format_distribution", "audit_issues", "iqr_fences",
        "exact_duplicates", "plan_applied", "plan_validated", "reliability", "events_semantic_duplicate",
        "corrupt_semantic_duplicate", "evaluate_disguisednull", "cell_diff", "csv_round_trip"]


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__

    return __spark_entry__


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, entry, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_every_sql_has_a_query(entry):
    assert set(entry.oracle_sql()) <= set(entry.queries())
