"""Every registered query against its SQL on DuckDB."""

import pytest

from checks.compare import database, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, FOLDER, name) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 16
    assert set(entry.oracle_sql()) <= set(entry.queries())
