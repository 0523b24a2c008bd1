"""Every registered query with a SQL twin returns the same rows in DuckDB."""

import duckdb
import pytest

from checks import registry
from checks.base import TABLES
from checks.compare import compare
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    line = compare(spark, con, name, SMALL)
    assert not line.startswith("FAIL"), line


def test_names_match():
    assert set(registry.oracles()) <= set(registry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3 * 4 * 8
