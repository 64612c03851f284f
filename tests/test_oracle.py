"""Every registered query against its SQL on the given tables."""

import os
from datetime import datetime
from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import oracle_queries
from mercato.queries import all_queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_sql():
    """The training-data operators, registered beside these, have tests of their own."""
    assert all_queries().keys() == oracle_queries().keys()
    assert all_queries().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, con, name):
    mine = contract.queries()[name](spark, DATA)
    assert difference(mine, con.sql(contract.oracle_sql()[name])) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def star_rows(spark, folder):
    """Customers 10 to 12 with an order each, delivered in different months; 11 is of the missing ones."""
    customers = spark.createDataFrame([(10,), (11,), (12,)], "c_custkey bigint")
    customers.write.parquet(f"{folder}/customer.parquet")
    orders = [(n, n, "F", datetime(2024, n - 9, 5)) for n in (10, 11, 12)]
    spark.createDataFrame(
        orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"
    ).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_profile_of_every_customer(spark, tmp_path):
    """Customer 10 is repeated."""
    found = contract.queries()["profile_customers"](spark, star_rows(spark, tmp_path))
    assert [r["non_null_count"] for r in found.collect()] == [4, 4, 4, 4]


def test_cohorts_of_every_customer(spark, tmp_path):
    """Customers 10 and 11 are one person."""
    found = contract.queries()["customer_cohorts"](spark, star_rows(spark, tmp_path))
    of_order = {r["order_id"]: (r["customer_unique_id"], r["cohort_index"]) for r in found.collect()}
    assert of_order == {10: (10, 0), 11: (10, 1), 12: (12, 0)}


def test_delivered_orders_of_every_customer(spark, tmp_path):
    found = contract.queries()["delivered_order_count"](spark, star_rows(spark, tmp_path))
    assert [tuple(r) for r in found.collect()] == [(3,)]
