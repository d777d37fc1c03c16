"""Registered queries against their checking SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as registered
from compare import compare, connect
from registry.catalog import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PICKED = [
    "revenue_with_all_level", "interval_join", "open_intervals_by_date", "price_quartiles", "stitch_across_years", "stg_speeches",
    "mart_speeches", "mart_bills", "quality_report_of_all_models", "scan_csv_with_declared_schema", "previous_row", "dash_by_member_metrics", "dash_topics",
]


@pytest.fixture(scope="module")
def checker():
    return connect(FOLDER)


@pytest.mark.parametrize("name", PICKED)
def test_query_agrees_with_sql(spark, checker, name):
    state, n, _, note = compare(spark, checker, FOLDER, name)
    assert (state, n > 0) == ("ok", True), note


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(registered.oracle_sql()) <= set(registered.queries())
