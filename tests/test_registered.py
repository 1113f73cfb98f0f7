"""Registered queries next to their SQL on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry
from checks import compare, registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# These run whole jobs or streams; test_jobs, test_stream and test_allocation cover them on small inputs.
SLOW = {
    "reprocess_range", "stream_daily_terms", "stream_restart", "stream_first_wins", "export_roundtrip", "export_one_day", "processed_days",
    "full_run_tables", "failed_links",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in SLOW])
def test_query_equals_sql(spark, con, name):
    ok, note = compare.compare(spark, con, name, SF)
    assert ok, note


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 30 and all(r.word for r in rows)
