"""Ranked and summarised reports over the marts.

A top-n report ends in sort + limit, which Spark runs as a per-task top n. Every sort
carries a unique tie-break, so the rows reported are always the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.classifiers import (
    SellerThresholds,
    StateThresholds,
    delay_bucket,
    delay_bucket_sort,
    delivery_status,
    risk_rank,
)
from mercato.functions.rates import mean, pct
from mercato.plans import cohort, delivery, sales
from mercato.schemas import Tables


def monthly_kpis(tables: Tables) -> DataFrame:
    return sales.monthly_kpis(tables).orderBy("purchase_month")


# Sales


def _categories(tables: Tables) -> DataFrame:
    return sales.shared(tables, "category_performance", sales.category_performance)


def _sellers(tables: Tables) -> DataFrame:
    return sales.shared(tables, "seller_performance", sales.seller_performance)


def category_top_revenue(tables: Tables, limit: int = 10) -> DataFrame:
    category = "product_category_name_english"
    return (
        _categories(tables)
        .orderBy(F.desc("total_revenue"), category)
        .limit(limit)
        .select(
            category,
            "total_orders",
            "total_order_items",
            "total_revenue",
            "avg_review_score",
            "avg_delivery_days",
            "late_item_rate_pct",
        )
    )


def category_worst_reviewed(
    tables: Tables, min_orders: int = 100, limit: int = 10
) -> DataFrame:
    category = "product_category_name_english"
    return (
        _categories(tables)
        .filter(F.col("total_orders") >= min_orders)
        .orderBy(F.asc_nulls_first("avg_review_score"), category)
        .limit(limit)
        .select(
            category,
            "total_orders",
            "total_revenue",
            "avg_review_score",
            "late_item_rate_pct",
            "avg_delivery_days",
        )
    )


def seller_top_revenue(tables: Tables, limit: int = 20) -> DataFrame:
    return _sellers(tables).orderBy(F.desc("total_revenue"), "seller_id").limit(limit)


def seller_top_established(
    tables: Tables, limits: SellerThresholds = SellerThresholds(), limit: int = 20
) -> DataFrame:
    return (
        _sellers(tables)
        .filter(F.col("total_orders") >= limits.established_orders)
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(limit)
        .select(
            "seller_id",
            "total_orders",
            "total_order_items",
            "total_revenue",
            "avg_review_score",
            "late_item_rate_pct",
            "low_review_item_rate_pct",
        )
    )


def seller_segment_summary(tables: Tables) -> DataFrame:
    """Sellers, revenue and unweighted means of the sellers' own averages per segment."""

    def seller_mean(name: str):
        return mean(F.sum(name), F.count(name))

    revenue = F.sum("total_revenue").cast("decimal(20,2)").alias("segment_revenue")
    return (
        sales.shared(tables, "seller_risk_segments", sales.seller_risk_segments)
        .groupBy("seller_segment")
        .agg(
            F.count(F.lit(1)).alias("seller_count"),
            revenue,
            seller_mean("avg_review_score").alias("avg_segment_review_score"),
            seller_mean("late_item_rate_pct").alias("avg_late_item_rate_pct"),
        )
        .orderBy(F.desc("segment_revenue"), "seller_segment")
    )


# Delivery


def delivery_performance_first(tables: Tables, limit: int = 20) -> DataFrame:
    """The first delivery rows by order.

    Every delivered order yields a row, so the first ``limit`` orders are enough. They are
    found once, as the one row of a scalar subquery; its keys reduce customers and reviews
    while these are scanned, and its rows are what is joined. So each table is read once and
    none is shuffled; the limit bounds the subquery.
    """
    first = sales.delivered(tables["orders"]).orderBy("order_id").limit(limit)
    found = first.agg(
        F.struct(
            F.collect_list("customer_id").alias("customer_id"),
            F.collect_list("order_id").alias("order_id"),
            F.collect_list(F.struct("*")).alias("orders"),
        )
    ).scalar()

    def only_of_first(name: str, key: str) -> DataFrame:
        return tables[name].filter(F.array_contains(found[key], F.col(key)))

    reduced = {
        "orders": first.sparkSession.range(1).select(F.inline(found["orders"])),
        "customers": only_of_first("customers", "customer_id"),
        "reviews": only_of_first("reviews", "order_id"),
    }
    reviews = reduced["reviews"].select("order_id", "review_score")
    return (
        delivery.delivered_with_customer(reduced)
        .join(reviews, "order_id", "left")
        .orderBy("order_id", "review_score")
        .limit(limit)
    )


def state_delivery_kpis(tables: Tables) -> DataFrame:
    """Delivery per state over all delivered orders, reviewed or not."""
    facts = sales.shared(tables, "order_facts", sales.order_facts)
    return (
        delivery.delivery_totals(facts, F.col("fan_out"), "customer_state")
        .select(
            "customer_state",
            F.col("total_orders").alias("delivered_orders"),
            delivery.measure("avg_delivery_days"),
            delivery.measure("avg_delay_days"),
            pct(F.col("late_rows"), F.col("rows"), 5).alias("late_delivery_rate_pct"),
            delivery.measure("avg_review_score"),
        )
        .orderBy(F.desc("late_delivery_rate_pct"), "customer_state")
    )


def _order_facts_only(tables: Tables) -> DataFrame:
    """Facts for summaries that use no customer column; spares the customer join."""
    return sales.shared(
        tables, "order_facts", lambda given: sales.order_facts(given, with_customer=False)
    )


def delivery_status_summary(tables: Tables) -> DataFrame:
    status = delivery_status(F.col("is_late")).alias("delivery_status")
    return (
        delivery.reviewed_totals(_order_facts_only(tables), status)
        .select(
            "delivery_status",
            "total_orders",
            delivery.measure("avg_review_score"),
            F.col("low").alias("low_review_orders"),
            delivery.measure("low_review_rate_pct"),
        )
        .orderBy("delivery_status")
    )


def review_impact_first(tables: Tables, limit: int = 20) -> DataFrame:
    return (
        sales.shared(tables, "delivery_review_impact", delivery.delivery_review_impact)
        .orderBy("order_purchase_timestamp", "order_id", "review_score")
        .limit(limit)
    )


def delay_bucket_summary(tables: Tables) -> DataFrame:
    delay = F.col("delay_days")
    bucket = delay_bucket(delay).alias("delay_bucket")
    position = delay_bucket_sort(delay).alias("_position")
    return (
        delivery.reviewed_totals(_order_facts_only(tables), bucket, position)
        .orderBy("_position")
        .select(
            "delay_bucket",
            "total_orders",
            delivery.measure("avg_review_score"),
            delivery.measure("low_review_rate_pct"),
            delivery.measure("high_review_rate_pct"),
        )
    )


def state_review_impact(
    tables: Tables, limits: StateThresholds = StateThresholds()
) -> DataFrame:
    facts = sales.shared(tables, "order_facts", sales.order_facts)
    return (
        delivery.reviewed_totals(facts, "customer_state")
        .filter(F.col("total_orders") >= limits.min_orders)
        .select(
            "customer_state",
            "total_orders",
            *map(delivery.measure, delivery.STATE_REVIEW_MEASURES),
        )
        .orderBy(F.desc("late_delivery_rate_pct"), "customer_state")
    )


def state_logistics_risk_ranked(
    tables: Tables, limits: StateThresholds = StateThresholds()
) -> DataFrame:
    return delivery.state_logistics_risk(tables, limits).orderBy(
        risk_rank(F.col("logistics_risk_segment")),
        F.desc("late_delivery_rate_pct"),
        "customer_state",
    )


# Cohorts


def customer_orders_first(tables: Tables, limit: int = 20) -> DataFrame:
    return (
        sales.shared(tables, "customer_orders", cohort.customer_orders)
        .orderBy("order_purchase_timestamp", "order_id")
        .limit(limit)
    )


def delivered_order_count(tables: Tables) -> DataFrame:
    orders = sales.shared(tables, "customer_orders", cohort.customer_orders)
    return orders.agg(F.count(F.lit(1)).alias("delivered_order_count"))


def cohort_counts(tables: Tables) -> DataFrame:
    return cohort.cohort_counts(tables).orderBy("cohort_month", "cohort_index")


def cohort_retention(tables: Tables) -> DataFrame:
    return cohort.cohort_retention(tables).orderBy("cohort_month", "cohort_index")


def cohort_retention_matrix(tables: Tables) -> DataFrame:
    return cohort.cohort_retention_matrix(tables).orderBy("cohort_month")


def customer_cohorts_first(tables: Tables, limit: int = 20) -> DataFrame:
    """The first cohort rows by cohort month and customer.

    Every customer has a row, so the first ``limit`` customers are enough. They come
    from one aggregate; only their orders are then read again.
    """
    orders = cohort.person_orders(tables)
    first = (
        orders.groupBy(cohort.PERSON)
        .agg(F.min("purchase_month").alias("cohort_month"))
        .orderBy("cohort_month", cohort.PERSON)
        .limit(limit)
    )
    return (
        cohort.with_cohort_columns(orders.join(F.broadcast(first), cohort.PERSON))
        .orderBy("cohort_month", cohort.PERSON, "order_id")
        .limit(limit)
    )


def orders_per_customer(tables: Tables) -> DataFrame:
    return (
        sales.shared(tables, "customer_orders", cohort.customer_orders)
        .groupBy(cohort.PERSON)
        .agg(F.count("order_id").alias("order_count"))
    )


def repeat_customer_rate(tables: Tables) -> DataFrame:
    """Customers, customers with more than one order, and their share."""
    person = F.col(cohort.PERSON)
    return (
        orders_per_customer(tables)
        .agg(
            F.count(person).alias("total_customers"),
            F.count_if(person.isNotNull() & (F.col("order_count") > 1)).alias("repeat_customers"),
        )
        .withColumn(
            "repeat_customer_rate_pct", pct(F.col("repeat_customers"), F.col("total_customers"))
        )
    )


def cohort_sizes(tables: Tables) -> DataFrame:
    return (
        sales.shared(tables, "cohort_retention", cohort.cohort_retention)
        .filter(F.col("cohort_index") == 0)
        .orderBy("cohort_month")
    )


def order_count_histogram(tables: Tables) -> DataFrame:
    return (
        orders_per_customer(tables)
        .groupBy("order_count")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .orderBy("order_count")
    )
