"""Every registered query against its SQL on the smallest tables."""

import re

import __spark_entry__ as contract
import pytest
from compare import compare, duck

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(TABLES)


def test_every_query_has_sql():
    """The text operators and their pipeline are tested in their own folder where SQL cannot express them."""
    own = {name for name in contract.queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_same_rows(spark, con, name):
    difference = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], TABLES)
    assert difference is None, difference


def test_entry(spark):
    assert contract.entry(spark).count() == 6
