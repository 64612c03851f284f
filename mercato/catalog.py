"""Names of the marts, as views for SQL users or as saved tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import cohort, delivery, sales
from mercato.schemas import STAGING_TABLES, Tables
from mercato.sources.files import PARTITIONED_BY

# The published name of each mart.
VIEWS = {
    "vw_sales_order_items": sales.sales_order_items,
    "vw_monthly_kpis": sales.monthly_kpis,
    "vw_delivery_performance": delivery.delivery_performance,
    "vw_category_performance": sales.category_performance,
    "vw_seller_performance": sales.seller_performance,
    "vw_seller_risk_segments": sales.seller_risk_segments,
    "vw_delivery_review_impact": delivery.delivery_review_impact,
    "vw_state_logistics_risk": delivery.state_logistics_risk,
    "vw_customer_orders": cohort.customer_orders,
    "vw_customer_cohorts": cohort.customer_cohorts,
    "vw_cohort_retention": cohort.cohort_retention,
    "vw_cohort_retention_matrix": cohort.cohort_retention_matrix,
}

STAGING = "staging"
ANALYTICS = "analytics"


def register_views(spark: SparkSession, tables: Tables) -> None:
    """Temporary views ``staging_<table>`` and one per mart; nothing is computed."""
    for name in STAGING_TABLES:
        tables[name].createOrReplaceTempView(f"{STAGING}_{name}")
    for name, build in VIEWS.items():
        build(tables).createOrReplaceTempView(name)


def create_namespaces(spark: SparkSession) -> None:
    for name in (STAGING, ANALYTICS):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _save(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(
            partition_by
        ).saveAsTable(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)


def save_staging(spark: SparkSession, tables: Tables) -> Tables:
    """Save the staging tables as ``staging.<table>`` and return them as read back."""
    create_namespaces(spark)
    for name in STAGING_TABLES:
        _save(tables[name], f"{STAGING}.{name}", PARTITIONED_BY.get(name))
    return {name: spark.table(f"{STAGING}.{name}") for name in STAGING_TABLES}


def save_marts(spark: SparkSession, tables: Tables) -> None:
    """Save every mart as ``analytics.<view name>``; a mart over another reads its table."""
    create_namespaces(spark)
    tables = dict(tables)
    # The joins of orders, customers and reviews that several marts share, for this run.
    shared = f"{ANALYTICS}.shared_order_facts"
    _save(sales.order_facts(tables), shared)
    tables["order_facts"] = spark.table(shared)
    for view, build in VIEWS.items():
        name = f"{ANALYTICS}.{view}"
        _save(build(tables), name)
        tables[view.removeprefix("vw_")] = spark.table(name)
    spark.sql(f"DROP TABLE {shared}")
