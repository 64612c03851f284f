"""Customer cohorts by month of first purchase, and their retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import dates
from mercato.functions.rates import pct
from mercato.plans.sales import delivered, shared
from mercato.schemas import Tables

PERSON = "customer_unique_id"


def customer_orders(tables: Tables) -> DataFrame:
    """Delivered orders of known customers, with the purchase month as a date."""
    customers = tables["customers"].select(
        "customer_id", PERSON, "customer_city", "customer_state"
    )
    return (
        delivered(tables["orders"])
        .filter(F.col("order_purchase_timestamp").isNotNull())
        .join(customers, "customer_id")
        .select(
            "order_id",
            "customer_id",
            PERSON,
            "order_status",
            "order_purchase_timestamp",
            dates.month_start(F.col("order_purchase_timestamp")).alias("purchase_month"),
            "customer_city",
            "customer_state",
        )
    )


def person_orders(tables: Tables) -> DataFrame:
    return shared(tables, "customer_orders", customer_orders).filter(F.col(PERSON).isNotNull())


def with_cohort_columns(orders: DataFrame) -> DataFrame:
    return orders.select(
        PERSON,
        "order_id",
        "purchase_month",
        "cohort_month",
        dates.month_gap(F.col("cohort_month"), F.col("purchase_month")).alias("cohort_index"),
        "customer_state",
    )


def customer_cohorts(tables: Tables) -> DataFrame:
    """Every order with its customer's first purchase month and the months since.

    First months are combined per task before their shuffle, and the join splits a
    customer with very many orders. Forms that shuffle the orders once were slower or left
    such a customer to one task (README, Measured).
    """
    orders = person_orders(tables)
    first = orders.groupBy(PERSON).agg(F.min("purchase_month").alias("cohort_month"))
    return with_cohort_columns(orders.join(first, PERSON))


def customer_months(tables: Tables) -> DataFrame:
    """Each customer's distinct purchase months as an array, in one shuffle.

    The array is bounded by the months in the calendar, not by the customer's orders.
    """
    return (
        person_orders(tables).groupBy(PERSON).agg(F.collect_set("purchase_month").alias("months"))
    )


def cohort_counts(tables: Tables) -> DataFrame:
    """Customers of each cohort who ordered in its n-th month.

    A customer has one array element per month, so counting elements counts customers.
    """
    visits = customer_months(tables).select(
        F.array_min("months").alias("cohort_month"), F.explode("months").alias("purchase_month")
    )
    index = dates.month_gap(F.col("cohort_month"), F.col("purchase_month"))
    return visits.groupBy("cohort_month", index.alias("cohort_index")).agg(
        F.count(F.lit(1)).alias("retained_customers")
    )


def cohort_retention(tables: Tables) -> DataFrame:
    """Retention of each cohort by month; the cohort's size is its own month 0.

    The window runs over the aggregate, which has at most months x months rows.
    """
    counts = shared(tables, "cohort_counts", cohort_counts)
    at_start = F.when(F.col("cohort_index") == 0, F.col("retained_customers"))
    size = F.max(at_start).over(Window.partitionBy("cohort_month"))
    return counts.withColumn("cohort_size", size).select(
        "cohort_month",
        "cohort_index",
        "cohort_size",
        "retained_customers",
        pct(F.col("retained_customers"), F.col("cohort_size")).alias("retention_rate_pct"),
    )


def cohort_retention_matrix(tables: Tables, max_index: int = 12) -> DataFrame:
    """One row per cohort, one column per month up to ``max_index``; gaps are NULL."""
    indexes = list(range(max_index + 1))
    return (
        shared(tables, "cohort_retention", cohort_retention)
        .groupBy("cohort_month", "cohort_size")
        .pivot("cohort_index", indexes)
        .agg(F.max("retention_rate_pct"))
        .withColumnsRenamed({str(index): f"month_{index}" for index in indexes})
    )
