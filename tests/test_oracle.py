"""Every registered query of the library against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry_point
from checks import queries  # noqa: F401  (registers on import)
from checks.compare import connect, difference
from checks.registry import ORACLES, QUERIES
from tests.conftest import TESTDATA


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
