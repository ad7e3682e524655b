"""Every catalog query with an SQL counterpart, side by side on the smallest tables."""

import pytest

import __spark_entry__ as contract
from oracles.check import difference, duck, type_difference
from oracles.sql import ORACLES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, connection, name):
    result = contract.queries()[name](spark, SMALL)
    described = connection.execute(f"describe {ORACLES[name]}").fetchall()
    assert type_difference(result.dtypes, {row[0]: row[1] for row in described}) is None
    assert difference(result.toPandas(), connection.execute(ORACLES[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_returns_the_plan(spark):
    plan = contract.entry(spark)
    assert plan.columns[0] == "product_category" and plan.count() > 0
