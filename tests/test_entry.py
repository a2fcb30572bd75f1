"""Driver contract: entry() runs, every query of the network has an oracle, and all agree with DuckDB on sf0.001."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["focal_repo_id", "count"]
    assert df.count() > 0


def test_every_network_query_has_an_oracle():
    assert set(entry._QUERIES) <= set(entry.oracle_sql()) and set(entry._QUERIES) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(entry._QUERIES))
def test_query_matches_oracle(spark, con, key):
    info = compare(spark, con, key, SF_SMALL, entry._QUERIES[key], entry.oracle_sql()[key])
    assert info["ok"], info
