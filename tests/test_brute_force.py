"""Every staging query against plain SQL over row-level joins, on hot keys and gaps."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from checks.oracle import STAGING_CTE, staged_queries
from mercato.operators.joins import left_join_split
from mercato.plans import cohort, delivery, sales
from mercato.queries import ON_STAGING
from tests import staged
from tests.conftest import rows

# More fixtures of the same shape, for a longer run: TEST_SEEDS=7,8,9
SEEDS = [int(seed) for seed in os.environ.get("TEST_SEEDS", "7").split(",")]


@pytest.fixture(scope="module", params=SEEDS)
def data(request, spark, tmp_path_factory):
    directory = staged.write(spark, tmp_path_factory.mktemp("staged"), request.param)
    con = duckdb.connect()
    for name, view in STAGING_CTE.items():
        con.sql(f"CREATE VIEW {view} AS SELECT * FROM '{directory}/{name}/*.parquet'")
    return staged.read(spark, directory), con


@pytest.mark.parametrize("name", ON_STAGING)
def test_same_as_sql(data, name):
    tables, con = data
    assert difference(ON_STAGING[name](tables), con.sql(staged_queries()[name])) is None


def test_split_join_equals_plain_join(spark):
    left = spark.range(12).withColumnRenamed("id", "k")
    right = spark.range(2000).select(
        F.when(F.col("id") < 1500, 1).otherwise(F.col("id") % 9).alias("k"), F.col("id").alias("value")
    )
    assert rows(left_join_split(left, right, "k")) == rows(left.join(right, "k", "left"))


def test_null_keys_do_not_match(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b")], "k int, l string")
    right = spark.createDataFrame([(None, 5), (None, 6), (1, 7)], "k int, v int")
    assert rows(left_join_split(left, right, "k")) == [(1, "b", 7), (None, "a", None)]


def test_invariants(data):
    tables, _ = data
    sellers = sales.seller_performance(tables)
    assert sellers.filter("total_revenue <> product_revenue + freight_revenue").count() == 0
    retention = cohort.cohort_retention(tables)
    assert retention.filter("retained_customers > cohort_size").count() == 0
    matrix = cohort.cohort_retention_matrix(tables)
    assert matrix.filter("month_0 <> 100 or month_0 is null").count() == 0
    buckets = delivery.delivery_review_impact(tables)
    assert buckets.select("delay_bucket", "delay_bucket_sort").distinct().count() == 7
