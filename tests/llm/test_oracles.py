"""Whole queries against DuckDB on the driver's tables."""

from __future__ import annotations

import os

import pytest

from compare import duckdb_rows, spark_rows
from veritable.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    """The contract's columns; a query may return more."""
    columns, wanted = duckdb_rows(SF_DIR, ORACLES[name])
    assert wanted
    assert spark_rows(QUERIES[name](spark, SF_DIR).select(*columns)) == (columns, wanted)
