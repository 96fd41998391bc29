"""Every registered query against its reference SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tests.parity import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


#: On the smallest data set no reading has its newest version in the first of two batches.
UPSERTS = ["b2_relational_upsert", "b10_schema_sync", "e6_upsert"]


@pytest.mark.parametrize("name", UPSERTS)
def test_upserts_on_more_data(spark, name):
    larger = SF.replace("sf0.001", "sf0.01")
    got = entry.queries()[name](spark, larger)
    assert compare(got, connect(larger), entry.oracle_sql()[name]) == []
