"""Every registered query against its SQL twin on the smallest test tables."""

import os
import re

import pytest

import __spark_entry__ as contract
from compare import difference, oracle_connection, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    of_the_rest = {name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert of_the_rest <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, connection, name):
    actual = spark_rows(contract.queries()[name](spark, SF_DIR))
    assert difference(oracle_rows(connection, contract.oracle_sql()[name]), actual) is None
