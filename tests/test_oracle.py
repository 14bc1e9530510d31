"""Every registered query of the core against its SQL twin on the smallest tables."""

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as contract
from periodledger.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


def test_every_query_has_a_twin_and_the_flagship_runs(spark):
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, DIR, QUERIES[name], ORACLES[name])
    assert problem is None, problem
