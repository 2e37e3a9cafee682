"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__
from litquarry.catalog import oracles, queries
from litquarry.catalog.check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries))
def test_query_equals_sql(spark, connection, name):
    good, note = compare(spark, connection, FOLDER, name)
    assert good, note


def test_entry_points(spark):
    assert set(__spark_entry__.queries()) >= set(queries)
    assert set(__spark_entry__.oracle_sql()) >= set(oracles)
    assert set(__spark_entry__.queries()) >= set(__spark_entry__.oracle_sql())
    assert __spark_entry__.entry(spark).count() > 0
