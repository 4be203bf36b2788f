"""Every registered query beside its DuckDB text on the smallest data set."""

import pytest

import __spark_entry__ as contract

from .compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
