"""Every registered query next to its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
import check
import oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return check.oracle_connection(SF_DIR)


def test_same_names():
    assert set(contract.search_queries()) == set(oracles.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.search_queries()))
def test_query_equals_sql(spark, connection, name):
    same, note = check.compare(spark, connection, SF_DIR, name)
    assert same, note


def test_entry(spark):
    assert contract.entry(spark).count() == 10
