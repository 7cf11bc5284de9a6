"""Every query against its checking SQL, on whole tables."""

import os

import compare
import pytest

from brindle.catalog import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = compare.connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    assert len(set(df.columns)) == len(df.columns)
    if name in ORACLES:
        assert compare.differences(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as driver

    if not os.path.isdir(driver.SMALL):
        pytest.skip("test tables absent")
    assert driver.entry(spark).count() == 10
    assert driver.queries().keys() == QUERIES.keys() | driver.EXTRA_QUERIES.keys()
    assert driver.oracle_sql().keys() == ORACLES.keys() | driver.EXTRA_ORACLES.keys()
