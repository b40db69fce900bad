"""Every registered query against its comparison SQL."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module
from reelpress.plans.catalog import CATALOG

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, con, name):
    query = CATALOG[name]
    df = query.run(spark, FOLDER)
    if query.sql is None:
        assert df.columns and df.count() >= 0
        return
    problem = difference(df, con, query.sql)
    assert problem in (None, "both sides are empty")


def test_contract(spark):
    queries, oracle = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracle) <= set(queries)
    assert set(CATALOG) <= set(queries)
    assert sum(query.sql is None for query in CATALOG.values()) <= 2
    assert entry_module.entry(spark).count() > 0
