"""Every registered query against its SQL oracle (DuckDB) on sf0.001.

The driver runs the same comparison at sf0.01; ``tests/oracle_check.py``
runs it at any scale from the command line.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry._registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["title", "engagement_events", "avg_watched_percent", "estimated_watch_minutes"]
