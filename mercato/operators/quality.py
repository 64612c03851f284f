"""Checks on the staging tables: counts, missing keys, orphans, key uniqueness.

Every check groups by the key with map-side combining before anything is shuffled or
joined, so a key with very many rows arrives as a handful of partial counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.profile import per_table
from mercato.schemas import KEYS, STAGING_TABLES, Tables

# Columns checked for NULL: (check, table, column).
NULL_CHECKS = (
    ("null_order_id", "orders", "order_id"),
    ("null_customer_id", "customers", "customer_id"),
    ("null_product_id", "products", "product_id"),
    ("null_order_items_order_id", "order_items", "order_id"),
    ("null_order_item_id", "order_items", "order_item_id"),
)

# Foreign keys checked for a missing parent: (check, table, parent, column).
ORPHAN_CHECKS = (
    ("orders_without_customer", "orders", "customers", "customer_id"),
    ("order_items_without_order", "order_items", "orders", "order_id"),
    ("order_items_without_product", "order_items", "products", "product_id"),
    ("payments_without_order", "payments", "orders", "order_id"),
)


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Tables) -> DataFrame:
    staged = {name: tables[name] for name in STAGING_TABLES}
    return per_table(staged, lambda df: df.agg(F.count(F.lit(1)).alias("row_count")))


def null_keys(tables: Tables) -> DataFrame:
    """Missing values per key column, one scan per table."""
    parts = []
    for table in dict.fromkeys(check[1] for check in NULL_CHECKS):
        checks = [(name, column) for name, owner, column in NULL_CHECKS if owner == table]
        counted = tables[table].agg(
            *[F.count_if(F.col(column).isNull()).alias(name) for name, column in checks]
        )
        rows = [
            F.struct(F.lit(name).alias("check_name"), F.col(name).alias("violations"))
            for name, _ in checks
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return _stack(parts)


def orphan_rows(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """One row: child rows whose ``column`` has no match; a NULL counts as unmatched."""
    per_key = child.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.join(parent.select(column), column, "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations")
    )


def orphans(tables: Tables) -> DataFrame:
    return _stack(
        [
            orphan_rows(tables[child], tables[parent], column).select(
                F.lit(name).alias("check_name"), "violations"
            )
            for name, child, parent, column in ORPHAN_CHECKS
        ]
    )


def key_audit(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: rows, rows with a NULL in the key, keys used more than once, verdict."""
    missing = reduce(Column.__or__, [F.col(name).isNull() for name in columns])
    per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    counted = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, F.col("_rows"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(~missing & (F.col("_rows") > 1)).alias("duplicate_keys"),
    )
    passed = (F.col("null_key_rows") == 0) & (F.col("duplicate_keys") == 0)
    return counted.withColumn("passed", passed)


def key_audits(tables: Tables) -> DataFrame:
    """The declared key of each table; pass reviews after ``dedup_reviews``."""
    return _stack(
        [
            key_audit(tables[name], columns).select(
                F.lit(name).alias("table_name"),
                F.lit(", ".join(columns)).alias("key_columns"),
                "row_count",
                "null_key_rows",
                "duplicate_keys",
                "passed",
            )
            for name, columns in KEYS.items()
        ]
    )


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Each value of ``column`` found on more than one row, with its row count."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def dedup_reviews(reviews: DataFrame) -> DataFrame:
    """One row per ``review_id``: lowest order, then score, then the other columns.

    Spark limits each group to its first row before the shuffle as well as after it,
    so a ``review_id`` shared by very many rows costs one row per input partition.
    """
    first = ["order_id", "review_score"]
    rest = [name for name in reviews.columns if name not in ("review_id", *first)]
    ranked = Window.partitionBy("review_id").orderBy(*first, *rest)
    return (
        reviews.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
