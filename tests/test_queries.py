"""Every registered query against DuckDB on the driver's tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from compare import duckdb_rows, spark_rows
from veritable.plans import oracles
from veritable.plans import queries as quality

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = quality.QUERIES
ORACLES = oracles.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duckdb_rows(SF_DIR, ORACLES[name])


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3


def test_scores_add_up(spark):
    """Scorecard counts sum to the log, and shares to one hundred."""
    rows = QUERIES["scorecard"](spark, SF_DIR).collect()
    assert sum(r.violation_count for r in rows) == QUERIES["violations_log"](spark, SF_DIR).count()
    shares = [r.pct_of_violations for r in QUERIES["composition"](spark, SF_DIR).collect()]
    assert abs(sum(shares) - 100) < 0.05
