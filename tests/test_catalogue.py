"""Every registered query against its SQL, over the smallest tables."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from compare import database, differences

from tallyhouse.catalogue.checks import CHECKS
from tallyhouse.catalogue.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_every_query_has_a_check():
    assert QUERIES.keys() == CHECKS.keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, connection, name):
    assert differences(queries()[name](spark, FOLDER), connection.execute(oracle_sql()[name])) is None


def test_entry(spark):
    assert entry(spark).count() > 0
