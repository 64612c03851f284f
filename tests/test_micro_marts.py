"""Marts, reports and checks on the six-order fixture, against values worked out by hand."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from mercato.functions.classifiers import StateThresholds
from mercato.operators import cleaning, quality
from mercato.plans import cohort, delivery, reports, sales
from mercato.sources import files
from tests import micro
from tests.conftest import rows


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    raw = files.read_raw_all(spark, micro.write_raw(tmp_path_factory.mktemp("raw")))
    return cleaning.clean_all(raw)


@pytest.fixture(scope="module")
def t(cleaned):
    return {**cleaned, "reviews": quality.dedup_reviews(cleaned["reviews"])}


def test_review_kept_is_the_lowest_order(t):
    assert rows(t["reviews"], "review_id", "order_id", "review_score") == [
        ("r1", "o1", 5), ("r2", "o1", 2), ("r3", "o2", 4), ("r4", "o3", 1),
    ]


def test_sales_rows_fan_out(t):
    sold = sales.sales_order_items(t)
    assert sold.count() == 9
    assert sold.filter("order_status = 'delivered'").count() == 8
    assert rows(sold.filter("order_id = 'o1'"), "order_item_id", "review_score") == [
        (1, 2), (1, 5), (2, 2), (2, 5),
    ]
    assert rows(
        sold.filter("order_id = 'o4'"), "product_category_name", "product_category_name_english"
    ) == [(None, "unknown")]


def test_monthly_kpis(t):
    got = reports.monthly_kpis(t)
    assert [tuple(row) for row in got.collect()] == [
        ("2018-01", 2, 2, D("320.00"), D("30.00"), D("350.00"), D("3.000000"), D("7.600000"),
         5, 5, D("100.00")),
        ("2018-02", 2, 2, D("30.50"), D("3.10"), D("33.60"), None, D("-1.000000"),
         0, 2, D("0.00")),
        ("2018-03", 1, 1, D("100.00"), D("10.00"), D("110.00"), D("4.000000"), D("4.000000"),
         0, 1, D("0.00")),
    ]
    assert dict(got.dtypes)["late_item_rate_pct"] == "decimal(5,2)"


def test_category_performance(t):
    got = rows(sales.category_performance(t).drop("avg_item_price", "avg_freight_value"))
    assert got == [
        ("health_beauty", 3, 4, 2, D("300.50"), D("30.10"), D("330.60"), D("3.666667"),
         D("4.250000"), D("50.00")),
        ("unknown", 3, 4, 3, D("150.00"), D("13.00"), D("163.00"), D("2.666667"),
         D("8.000000"), D("75.00")),
    ]


def test_seller_performance_and_segments(t):
    got = rows(sales.seller_performance(t).drop("avg_item_price", "avg_freight_value"))
    assert got == [
        ("s1", 3, 4, 2, D("320.00"), D("30.00"), D("350.00"), D("3.000000"), D("7.000000"),
         D("75.00"), D("50.00")),
        ("s2", 2, 3, 2, D("130.00"), D("13.00"), D("143.00"), D("3.500000"), D("7.000000"),
         D("66.67"), D("33.33")),
        ("s3", 1, 1, 1, D("0.50"), D("0.10"), D("0.60"), None, D("-1.000000"),
         D("0.00"), D("0.00")),
    ]
    segments = sales.seller_risk_segments(t)
    assert {row.seller_segment for row in segments.collect()} == {"Low Volume Seller"}
    assert "avg_item_price" not in segments.columns
    assert rows(reports.seller_segment_summary(t)) == [
        ("Low Volume Seller", 3, D("493.60"), D("3.250000"), D("47.223333")),
    ]


def test_item_averages(t):
    got = {row.seller_id: row for row in sales.seller_performance(t).collect()}
    assert (got["s2"].avg_item_price, got["s2"].avg_freight_value) == (
        D("43.333333"), D("4.333333"),
    )


def test_delivery_performance(t):
    columns = ("order_id", "delivery_days", "is_late", "approval_days", "handling_days",
               "carrier_delivery_days", "delay_days", "review_score")
    assert rows(delivery.delivery_performance(t), *columns) == [
        ("o1", 7, 1, 1, 1, 6, 0, 2),
        ("o1", 7, 1, 1, 1, 6, 0, 5),
        ("o2", 4, 0, 0, 1, 3, -15, 4),
        ("o3", 10, 1, 0, 2, 8, 2, 1),
        ("o4", None, 0, 0, 1, None, None, None),
        ("o6", -1, 0, None, None, None, -9, None),
    ]
    assert rows(reports.delivery_performance_first(t)) == rows(delivery.delivery_performance(t))


def test_status_and_buckets(t):
    assert rows(reports.delivery_status_summary(t)) == [
        ("Late", 2, D("2.666667"), 2, D("66.67")),
        ("On Time or Early", 1, D("4.000000"), 0, D("0.00")),
    ]
    assert [tuple(row) for row in reports.delay_bucket_summary(t).collect()] == [
        ("Early by 7+ days", 1, D("4.000000"), D("0.00"), D("100.00")),
        ("Delivered on estimated date", 1, D("3.500000"), D("50.00"), D("50.00")),
        ("Late by 1-3 days", 1, D("1.000000"), D("100.00"), D("0.00")),
    ]


def test_states(t):
    assert rows(delivery.state_logistics_risk(t)) == []
    got = rows(delivery.state_logistics_risk(t, StateThresholds(min_orders=1)))
    assert got == [
        ("RJ", 1, D("10.000000"), D("2.000000"), D("100.00"), D("1.000000"), D("100.00"),
         "High Risk"),
        ("SP", 2, D("6.000000"), D("-5.000000"), D("66.67"), D("3.666667"), D("33.33"),
         "High Risk"),
    ]
    assert [row.customer_state for row in reports.state_delivery_kpis(t).collect()] == [
        "SP", "RJ", "MG",
    ]


def test_cohorts(t):
    jan, feb = dt.date(2018, 1, 1), dt.date(2018, 2, 1)
    assert rows(cohort.cohort_retention(t)) == [
        (jan, 0, 2, 2, D("100.00")),
        (jan, 2, 2, 1, D("50.00")),
        (feb, 0, 2, 2, D("100.00")),
    ]
    matrix = reports.cohort_retention_matrix(t)
    assert matrix.columns == ["cohort_month", "cohort_size", *[f"month_{i}" for i in range(13)]]
    assert [tuple(row)[:5] for row in matrix.collect()] == [
        (jan, 2, D("100.00"), None, D("50.00")),
        (feb, 2, D("100.00"), None, None),
    ]
    assert rows(reports.repeat_customer_rate(t)) == [(4, 1, D("25.00"))]
    assert rows(reports.order_count_histogram(t)) == [(1, 3), (2, 1)]
    assert rows(reports.delivered_order_count(t)) == [(5,)]


def test_repeat_rate_without_customers(t):
    empty = {**t, "orders": t["orders"].limit(0)}
    assert rows(reports.repeat_customer_rate(empty)) == [(0, 0, None)]


def test_quality(t, cleaned):
    assert dict(rows(quality.orphans(t)))["order_items_without_product"] == 1
    assert rows(quality.repeated_keys(cleaned["reviews"], "review_id")) == [("r4", 2)]
    assert rows(quality.key_audit(cleaned["reviews"], ("review_id",))) == [(5, 0, 1, False)]
    assert all(row.passed for row in quality.key_audits(t).collect())
    assert all(row.violations == 0 for row in quality.null_keys(t).collect())
    assert dict(rows(quality.row_counts(t))) == {
        "orders": 6, "order_items": 7, "products": 3, "customers": 6, "payments": 4, "reviews": 4,
    }


def test_missing_keys_are_reported(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", None), (None, None), (None, None)], "k string, n int"
    )
    assert rows(quality.key_audit(df, ("k", "n"))) == [(5, 3, 1, False)]
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(quality.orphan_rows(df, parent, "k")) == [(3,)]
    assert rows(quality.orphan_rows(df.limit(0), parent, "k")) == [(0,)]


def test_shuffle_partition_count_does_not_matter(t, conf):
    before = rows(sales.seller_performance(t)), rows(cohort.customer_cohorts(t))
    conf(spark__sql__shuffle__partitions="3")
    assert (rows(sales.seller_performance(t)), rows(cohort.customer_cohorts(t))) == before


def test_retention_window_equals_self_join(t):
    counts = cohort.cohort_counts(t)
    sizes = counts.filter("cohort_index = 0").select(
        "cohort_month", F.col("retained_customers").alias("size")
    )
    joined = counts.join(sizes, "cohort_month")
    assert rows(cohort.cohort_retention(t), "cohort_month", "cohort_index", "cohort_size") == rows(
        joined, "cohort_month", "cohort_index", "size"
    )
