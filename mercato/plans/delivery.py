"""Delivery performance and its effect on review scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import dates
from mercato.functions.classifiers import (
    StateThresholds,
    delay_bucket,
    delay_bucket_sort,
    delivery_status,
    flag,
    is_high,
    is_low,
    logistics_risk,
)
from mercato.functions.rates import exact_pct, mean, pct
from mercato.operators.joins import left_join_split
from mercato.plans.sales import delivered, order_facts, shared
from mercato.schemas import ORDER_TIMESTAMPS, Tables


def delivered_with_customer(tables: Tables) -> DataFrame:
    """Delivered orders, also those of unknown customers, with their day gaps."""
    customers = tables["customers"].select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )
    purchased, approved, carried, received, estimated = map(F.col, ORDER_TIMESTAMPS)
    return (
        delivered(tables["orders"])
        .join(customers, "customer_id", "left")
        .select(
            "order_id",
            "customer_id",
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "order_status",
            *ORDER_TIMESTAMPS,
            "delivery_days",
            "is_late",
            dates.day_boundaries(purchased, approved).alias("approval_days"),
            dates.day_boundaries(approved, carried).alias("handling_days"),
            dates.day_boundaries(carried, received).alias("carrier_delivery_days"),
            dates.day_boundaries(estimated, received).alias("delay_days"),
        )
    )


def delivery_performance(tables: Tables) -> DataFrame:
    """One row per delivered order and review; one row for an order without review."""
    reviews = tables["reviews"].select("order_id", "review_score")
    return left_join_split(delivered_with_customer(tables), reviews, "order_id")


def delivery_review_impact(tables: Tables) -> DataFrame:
    """Delivered orders with a score, classified by delay and score.

    Only scored reviews matter, so the join is an inner one and adaptive execution can
    split an order with very many reviews by itself.
    """
    score = F.col("review_score")
    scored = tables["reviews"].select("order_id", "review_score").filter(score.isNotNull())
    return (
        delivered_with_customer(tables)
        .join(scored, "order_id")
        .select(
            "order_id",
            "customer_unique_id",
            "customer_state",
            "order_purchase_timestamp",
            "delivery_days",
            "delay_days",
            "is_late",
            "review_score",
            delivery_status(F.col("is_late")).alias("delivery_status"),
            delay_bucket(F.col("delay_days")).alias("delay_bucket"),
            delay_bucket_sort(F.col("delay_days")).alias("delay_bucket_sort"),
            flag(is_low(score)).alias("is_low_review"),
            flag(is_high(score)).alias("is_high_review"),
        )
    )


def delivery_totals(facts: DataFrame, weight: Column, *group: Column | str) -> DataFrame:
    """Sums per ``group`` over review rows, ``weight`` being the review rows per order."""
    late = F.col("is_late") == 1
    totals = [
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(weight).alias("rows"),
        F.sum(F.when(late, weight).otherwise(0)).alias("late_rows"),
        F.sum(F.col("delivery_days") * weight).alias("delivery_sum"),
        F.sum(F.when(F.col("delivery_days").isNotNull(), weight)).alias("delivery_rows"),
        F.sum(F.col("delay_days") * weight).alias("delay_sum"),
        F.sum(F.when(F.col("delay_days").isNotNull(), weight)).alias("delay_rows"),
        *[F.sum(name).alias(name) for name in ("scored", "score_sum", "low", "high")],
    ]
    return facts.groupBy(*group).agg(*totals)


def measure(name: str) -> Column:
    """A published measure over the sums of ``delivery_totals``."""
    rows = F.col("rows")
    measures = {
        "avg_delivery_days": lambda: mean(F.col("delivery_sum"), F.col("delivery_rows")),
        "avg_delay_days": lambda: mean(F.col("delay_sum"), F.col("delay_rows")),
        "avg_review_score": lambda: mean(F.col("score_sum"), F.col("scored")),
        "late_delivery_rate_pct": lambda: pct(F.col("late_rows"), rows),
        "low_review_rate_pct": lambda: pct(F.col("low"), rows),
        "high_review_rate_pct": lambda: pct(F.col("high"), rows),
    }
    return measures[name]().alias(name)


def reviewed_totals(facts: DataFrame, *group: Column | str) -> DataFrame:
    """Sums over the scored reviews of delivered orders."""
    return delivery_totals(facts.filter(F.col("scored") > 0), F.col("scored"), *group)


STATE_REVIEW_MEASURES = (
    "avg_delivery_days",
    "avg_delay_days",
    "late_delivery_rate_pct",
    "avg_review_score",
    "low_review_rate_pct",
)


def state_logistics_risk(
    tables: Tables, limits: StateThresholds = StateThresholds()
) -> DataFrame:
    """Review impact and risk segment of each state with enough orders."""
    late_pct = exact_pct(F.col("late_rows"), F.col("rows"))
    avg_review = mean(F.col("score_sum"), F.col("scored"))
    facts = shared(tables, "order_facts", order_facts)
    return (
        reviewed_totals(facts, "customer_state")
        .filter(F.col("total_orders") >= limits.min_orders)
        .select(
            "customer_state",
            "total_orders",
            *map(measure, STATE_REVIEW_MEASURES),
            logistics_risk(late_pct, avg_review, limits).alias("logistics_risk_segment"),
        )
    )
