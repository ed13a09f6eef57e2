"""Every registered query gives what its SQL gives."""

import os

import pytest
from oracle import TESTDATA, connect, differences

import __spark_entry__ as contract
from touchline.catalog import load

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = contract.queries()
SQL = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_catalog_query_has_sql():
    assert set(load()) <= set(SQL)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
