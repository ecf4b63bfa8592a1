"""Registered queries against their SQL on the smallest shared tables."""

import os

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as contract

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
ORACLE = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, name):
    assert difference(contract.queries()[name](spark, SF_DIR), connection, ORACLE[name]) is None


def test_entry_has_one_row_per_customer(spark):
    df = contract.entry(spark)
    members = sum(spark.read.parquet(f"{contract.SMOKE_DIR}/{t}.parquet").count() for t in ("customer", "supplier"))
    assert df.count() == members
