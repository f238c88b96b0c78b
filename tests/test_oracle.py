"""Every registered query against its SQL statement."""

import pytest

import __spark_entry__ as contract
from check_oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_every_query_of_the_library_has_sql():
    from tidewater.plans import registry

    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["revenue_key", "n_events", "revenue", "total_count"] and df.count() > 0
