"""Every registered query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as contract
from windrow.plans.oracles import all_oracles
from windrow.plans.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, oracle, sf_dir, name):
    assert difference(spark, oracle, QUERIES[name], ORACLES[name], sf_dir) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
