"""Every registered query against SQL on another engine."""

import pytest

import __spark_entry__ as entry
from checks import oracle
from checks.compare import compare
from tests.conftest import SMALL


def test_every_query_has_an_oracle():
    assert set(entry.REGISTERED) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", entry.REGISTERED)
def test_query_equals_oracle(spark, duckdb_small, name):
    assert compare(spark, duckdb_small, name, SMALL) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
