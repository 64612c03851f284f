"""Every operator, mart and report by name, over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.operators import cleaning, profile, quality
from mercato.plans import cohort, delivery, reports, sales
from mercato.schemas import STAGING_TABLES, Tables
from mercato.session import configure
from mercato.sources import files, star

Query = Callable[[SparkSession, str], DataFrame]


class _OnDemand(dict):
    """Tables built when first asked for, so a query opens only the files it reads."""

    def __init__(self, builders: dict[str, Query], spark: SparkSession, sf_dir: str):
        super().__init__()
        self._build = lambda name: builders[name](spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._build(name)
        return self[name]


def _over(builders: dict[str, Query], build: Callable[[Tables], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(_OnDemand(builders, configure(spark), sf_dir))

    return query


def _profile_of(name: str) -> Callable[[Tables], DataFrame]:
    return lambda tables: profile.profile(tables[name])


# Operators that work on the tables as they arrive.
ON_RAW: dict[str, Callable[[Tables], DataFrame]] = {
    **{f"profile_{name}": _profile_of(name) for name in STAGING_TABLES},
    "duplicate_rows": lambda t: profile.per_table(
        {name: t[name] for name in STAGING_TABLES}, profile.duplicate_rows
    ),
    "profile_counted": lambda t: profile.per_table(
        {name: cleaning.count_copies(t[name]) for name in STAGING_TABLES}, profile.profile_counted
    ),
    "dedup_rows": lambda t: cleaning.drop_duplicate_rows(t["reviews"]),
    "clean_orders": lambda t: cleaning.clean_orders(t["orders"]),
    "clean_order_items": lambda t: cleaning.clean_order_items(t["order_items"]),
    "clean_products": lambda t: cleaning.clean_products(t["products"], t["category_translation"]),
    "clean_customers": lambda t: cleaning.drop_duplicate_rows(t["customers"]),
    "clean_payments": lambda t: cleaning.drop_duplicate_rows(t["payments"]),
}

# Operators on reviews that still share ids.
ON_REPEATED_REVIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "dq_review_duplicates": lambda t: quality.repeated_keys(t["reviews"], "review_id"),
    "dedup_reviews": lambda t: quality.dedup_reviews(t["reviews"]),
}

# Operators on text columns as the files hold them.
ON_TEXT: dict[str, Callable[[Tables], DataFrame]] = {
    "nullify_tokens": lambda t: files.nullify_tokens(t["order_text"]),
}

# Checks of keys, which run on tables that break them.
KEY_CHECKS = ("dq_null_keys", "dq_orphans", "dq_key_audit")

# Queries on all customers, also those that the other queries go without.
OF_ALL_CUSTOMERS = ("profile_customers", "customer_cohorts", "delivered_order_count")

ON_STAGING: dict[str, Callable[[Tables], DataFrame]] = {
    "dq_row_counts": quality.row_counts,
    "dq_null_keys": quality.null_keys,
    "dq_orphans": quality.orphans,
    "dq_key_audit": quality.key_audits,
    "sales_order_items": sales.sales_order_items,
    "monthly_kpis": reports.monthly_kpis,
    "category_performance": sales.category_performance,
    "seller_performance": sales.seller_performance,
    "seller_risk_segments": sales.seller_risk_segments,
    "delivery_performance": delivery.delivery_performance,
    "delivery_review_impact": delivery.delivery_review_impact,
    "state_logistics_risk": delivery.state_logistics_risk,
    "customer_orders": cohort.customer_orders,
    "customer_cohorts": cohort.customer_cohorts,
    "cohort_retention": reports.cohort_retention,
    "cohort_retention_matrix": reports.cohort_retention_matrix,
    "delivery_performance_top20": reports.delivery_performance_first,
    "state_delivery_kpis": reports.state_delivery_kpis,
    "category_top10_revenue": reports.category_top_revenue,
    "category_worst_reviewed": reports.category_worst_reviewed,
    "seller_top20_revenue": reports.seller_top_revenue,
    "seller_top20_established": reports.seller_top_established,
    "seller_segment_summary": reports.seller_segment_summary,
    "delivery_status_summary": reports.delivery_status_summary,
    "review_impact_top20": reports.review_impact_first,
    "delay_bucket_summary": reports.delay_bucket_summary,
    "state_review_impact": reports.state_review_impact,
    "state_logistics_risk_ranked": reports.state_logistics_risk_ranked,
    "customer_orders_top20": reports.customer_orders_first,
    "delivered_order_count": reports.delivered_order_count,
    "cohort_counts": reports.cohort_counts,
    "customer_cohorts_top20": reports.customer_cohorts_first,
    "repeat_customer_rate": reports.repeat_customer_rate,
    "cohort_sizes": reports.cohort_sizes,
    "order_count_histogram": reports.order_count_histogram,
}


def all_queries() -> dict[str, Query]:
    repeated = {**star.STAGING, "reviews": star.reviews}
    groups = (
        (star.RAW, ON_RAW),
        (
            {**star.RAW, "customers": star.all_raw_customers},
            {name: ON_RAW[name] for name in OF_ALL_CUSTOMERS if name in ON_RAW},
        ),
        ({"order_text": star.order_text}, ON_TEXT),
        (repeated, ON_REPEATED_REVIEWS),
        (star.STAGING, ON_STAGING),
        (
            {**star.STAGING, "customers": star.all_customers},
            {name: ON_STAGING[name] for name in OF_ALL_CUSTOMERS if name in ON_STAGING},
        ),
        (star.FAULTY, {name: ON_STAGING[name] for name in KEY_CHECKS}),
    )
    return {
        name: _over(builders, build)
        for builders, builds in groups
        for name, build in builds.items()
    }
