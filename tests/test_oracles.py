"""Every registered query against its SQL, on the smallest data set."""

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as entry_module
from basketlab.plans import oracles
from basketlab.plans.queries import REGISTRY

QUERIES = dict(REGISTRY)
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    difference, rows = compare(spark, con, SMALL, name, QUERIES[name], ORACLES[name])
    assert difference == ""
    # on the smallest data every cart fires a rule, so the fallback has nothing to do
    assert rows > 0 or name == "fallback"


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["cart_id", "rank", "item", "source", "rule", "confidence", "lift", "support"]
    assert df.count() > 0
