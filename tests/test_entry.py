"""Every registered query against its SQL on the smallest tables."""

import pytest
from support import TESTDATA

import __spark_entry__ as entry
from checks.compare import database, difference


@pytest.fixture(scope="module")
def con():
    return database(TESTDATA)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, TESTDATA) is None
