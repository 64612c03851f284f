"""Order-item sales: the row-level mart and the KPIs by month, category and seller.

The row-level mart repeats each order item once per review of its order, and the KPIs
are defined over those repeated rows. The KPIs never build them: an order contributes
its number of reviews as a weight, so an order with many items and many reviews costs
one row per group instead of items x reviews rows.

Distinct counts follow from the keys. An order belongs to one customer, so grouping by
(group, customer) and then by (group) counts orders and customers exactly, without
repeating rows per distinct count, and spreads a hot group over its customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import dates
from mercato.functions.classifiers import (
    SellerThresholds,
    is_high,
    is_low,
    seller_segment,
)
from mercato.functions.rates import cents, mean, money, pct
from mercato.operators.joins import left_join_split
from mercato.schemas import Tables

UNKNOWN = "unknown"


def shared(tables: Tables, name: str, build) -> DataFrame:
    """A result written earlier and passed along with the tables, else built here."""
    return tables[name] if name in tables else build(tables)


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == "delivered")


def items_with_category(tables: Tables) -> DataFrame:
    products = tables["products"].select(
        "product_id", "product_category_name", "product_category_name_english"
    )
    english = F.coalesce("product_category_name_english", F.lit(UNKNOWN))
    return (
        tables["order_items"]
        .join(products, "product_id", "left")
        .withColumn("product_category_name_english", english)
    )


def sales_order_items(tables: Tables) -> DataFrame:
    """One row per order item and review of its order, for orders of every status."""
    reviews = tables["reviews"].select("order_id", "review_score")
    customers = tables["customers"].select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )
    buyers = tables["orders"].join(customers, "customer_id")
    reviewed = left_join_split(buyers, reviews, "order_id")
    return (
        items_with_category(tables)
        .join(reviewed, "order_id")
        .select(
            "order_id",
            "customer_id",
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "order_status",
            "order_purchase_timestamp",
            "purchase_month",
            "order_item_id",
            "product_id",
            "seller_id",
            "price",
            "freight_value",
            "product_category_name",
            "product_category_name_english",
            "review_score",
            "delivery_days",
            "is_late",
        )
    )


def review_totals(reviews: DataFrame) -> DataFrame:
    """Per order: reviews, scored reviews, sum of scores, low and high scores."""
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count(score).alias("scored"),
        F.sum(score).alias("score_sum"),
        F.count_if(is_low(score)).alias("low"),
        F.count_if(is_high(score)).alias("high"),
    )


def with_review_totals(orders: DataFrame, tables: Tables) -> DataFrame:
    """Add the review totals of each row's order; 0 without review.

    ``fan_out`` is the number of review rows the order has in the row-level marts.
    """

    def none_as_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).alias(name)

    return orders.join(review_totals(tables["reviews"]), "order_id", "left").select(
        *orders.columns,
        F.coalesce("reviews", F.lit(1)).alias("fan_out"),
        *map(none_as_zero, ("scored", "score_sum", "low", "high")),
    )


def delivered_facts(tables: Tables, with_customer: bool = True) -> DataFrame:
    """One narrow row per delivered order, with its customer's person and state.

    ``has_customer`` tells sales (which needs the customer) from delivery (which does
    not). Summaries that use no customer column leave the customer join out.
    """
    delay = dates.day_boundaries(
        F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
    )
    orders = delivered(tables["orders"])
    customer_columns = []
    if with_customer:
        customers = tables["customers"].select(
            "customer_id", "customer_unique_id", "customer_state", F.lit(True).alias("_known")
        )
        orders = orders.join(customers, "customer_id", "left")
        customer_columns = [
            "customer_unique_id",
            "customer_state",
            F.coalesce("_known", F.lit(False)).alias("has_customer"),
        ]
    return orders.select(
        "order_id",
        *customer_columns,
        "purchase_month",
        "delivery_days",
        delay.alias("delay_days"),
        "is_late",
    )


def order_facts(tables: Tables, with_customer: bool = True) -> DataFrame:
    """One row per delivered order with its customer and review totals."""
    return with_review_totals(delivered_facts(tables, with_customer), tables)


def _item_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("items"),
        F.sum(cents(F.col("price"))).alias("price"),
        F.sum(cents(F.col("freight_value"))).alias("freight"),
    ]


def month_lines(tables: Tables) -> DataFrame:
    """One row per delivered order with items. The items combine before they are joined."""
    items = tables["order_items"].groupBy("order_id").agg(*_item_measures())
    facts = shared(tables, "order_facts", order_facts).filter("has_customer")
    return facts.join(items, "order_id")


def group_lines(tables: Tables, items: DataFrame, group: str) -> DataFrame:
    """One row per delivered order and ``group`` of its items.

    Orders and items meet in one shuffle by order, which the grouping and the review
    join then reuse. Both inputs of that first join come straight out of a shuffle, so an
    order with very many items is split, and is down to one row per group afterwards.
    """
    ready = "order_facts" in tables
    orders = tables["order_facts"] if ready else delivered_facts(tables)
    kept = ["order_id", "customer_unique_id", "delivery_days", "is_late"]
    if ready:
        kept += ["fan_out", "scored", "score_sum", "low"]
    lines = (
        orders.filter("has_customer")
        .select(*kept)
        .join(items.select("order_id", group, "price", "freight_value"), "order_id")
        .groupBy(*kept, group)
        .agg(*_item_measures())
    )
    return lines if ready else with_review_totals(lines, tables)


def sales_kpis(lines: DataFrame, group: str) -> DataFrame:
    """All sales measures per ``group``, from one row per order and group."""
    rows = F.col("items") * F.col("fan_out")
    late = F.col("is_late") == 1
    days = F.col("delivery_days")
    measures = {
        "rows": rows,
        "late_rows": F.when(late, rows).otherwise(0),
        "low_rows": F.col("items") * F.col("low"),
        "score_rows": F.col("items") * F.col("scored"),
        "score_sum": F.col("items") * F.col("score_sum"),
        "day_rows": F.when(days.isNotNull(), rows).otherwise(0),
        "day_sum": F.coalesce(days * rows, F.lit(0)),
        "price": F.col("price") * F.col("fan_out"),
        "freight": F.col("freight") * F.col("fan_out"),
    }
    per_customer = lines.groupBy(group, "customer_unique_id").agg(
        F.count(F.lit(1)).alias("orders"),
        *[F.sum(value).alias(name) for name, value in measures.items()],
    )
    totals = per_customer.groupBy(group).agg(
        F.count("customer_unique_id").alias("unique_customers"),
        F.sum("orders").alias("total_orders"),
        *[F.sum(name).alias(name) for name in measures],
    )
    return totals.select(
        group,
        "total_orders",
        F.col("rows").alias("total_order_items"),
        "unique_customers",
        money(F.col("price")).alias("product_revenue"),
        money(F.col("freight")).alias("freight_revenue"),
        money(F.col("price") + F.col("freight")).alias("total_revenue"),
        mean(money(F.col("price")), F.col("rows")).alias("avg_item_price"),
        mean(money(F.col("freight")), F.col("rows")).alias("avg_freight_value"),
        mean(F.col("score_sum"), F.col("score_rows")).alias("avg_review_score"),
        mean(F.col("day_sum"), F.col("day_rows")).alias("avg_delivery_days"),
        F.col("late_rows").alias("late_order_items"),
        pct(F.col("late_rows"), F.col("rows")).alias("late_item_rate_pct"),
        pct(F.col("low_rows"), F.col("rows")).alias("low_review_item_rate_pct"),
    )


def monthly_kpis(tables: Tables) -> DataFrame:
    """Sales per purchase month. Needs no product, so products are not joined."""
    return sales_kpis(month_lines(tables), "purchase_month").select(
        "purchase_month",
        "total_orders",
        "unique_customers",
        "product_revenue",
        "freight_revenue",
        "total_revenue",
        "avg_review_score",
        "avg_delivery_days",
        "late_order_items",
        "total_order_items",
        F.col("late_item_rate_pct").cast("decimal(5,2)").alias("late_item_rate_pct"),
    )


GROUP_MEASURES = (
    "total_orders",
    "total_order_items",
    "unique_customers",
    "product_revenue",
    "freight_revenue",
    "total_revenue",
    "avg_item_price",
    "avg_freight_value",
    "avg_review_score",
    "avg_delivery_days",
    "late_item_rate_pct",
)


def category_performance(tables: Tables) -> DataFrame:
    """Sales per English category; items of unknown products count as ``unknown``."""
    category = "product_category_name_english"
    lines = group_lines(tables, items_with_category(tables), category)
    return sales_kpis(lines, category).select(category, *GROUP_MEASURES)


def seller_performance(tables: Tables) -> DataFrame:
    """Sales per seller. Needs no product, so products are not joined."""
    lines = group_lines(tables, tables["order_items"], "seller_id")
    return sales_kpis(lines, "seller_id").select(
        "seller_id", *GROUP_MEASURES, "low_review_item_rate_pct"
    )


def seller_risk_segments(
    tables: Tables, limits: SellerThresholds = SellerThresholds()
) -> DataFrame:
    segment = seller_segment(
        F.col("total_orders"),
        F.col("total_revenue"),
        F.col("avg_review_score"),
        F.col("late_item_rate_pct"),
        F.col("low_review_item_rate_pct"),
        limits,
    )
    return (
        shared(tables, "seller_performance", seller_performance)
        .withColumn("seller_segment", segment)
        .drop("avg_item_price", "avg_freight_value")
    )
