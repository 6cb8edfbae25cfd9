"""Every registered query against its SQL twin, over whole small tables."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from lakeloom.workload.oracles import ORACLES
from lakeloom.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result(spark, sql, name):
    assert compare(QUERIES[name](spark, SF_DIR), sql, ORACLES[name]) == []


def test_entry(spark):
    assert contract.entry(spark).columns == ["category", "status", "revenue", "quantity"]
