"""Raw tables to staging tables.

Order of work: drop full-row duplicates, parse timestamps, fill, filter, look up,
derive, rename. Every step is lazy; an action happens only where a caller writes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import dates
from mercato.schemas import ORDER_TIMESTAMPS, PRODUCT_RENAMES, STAGING_TABLES, Tables

UNKNOWN_CATEGORY = "unknown"

Distinct = Callable[[DataFrame], DataFrame]


# The column that counts a row's copies; no table may have one of that name.
COPIES = "_copies"


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of each distinct row; NULLs compare equal."""
    return df.dropDuplicates()


def count_copies(df: DataFrame) -> DataFrame:
    """One copy of each distinct row with the number of its copies, in one shuffle.

    Written once, it serves the duplicate report, the profile and the cleaning, none of
    which then shuffles whole rows again.
    """
    columns = [F.col(f"`{name}`") for name in df.columns]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))


def without_copies(counted: DataFrame) -> DataFrame:
    """The distinct rows of ``count_copies``."""
    return counted.drop(COPIES)


def parse_order_timestamps(orders: DataFrame) -> DataFrame:
    """Cast the timestamp columns; under ANSI a malformed value fails the job."""
    return orders.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name in ORDER_TIMESTAMPS}
    )


def with_delivery_kpis(orders: DataFrame) -> DataFrame:
    """Add ``delivery_days``, ``is_late`` and ``purchase_month``.

    ``is_late`` compares full timestamps and is 0 for an undelivered order.
    ``purchase_month`` is NULL, not a text placeholder, for a missing purchase time.
    """
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    late = delivered > F.col("order_estimated_delivery_date")
    return orders.withColumns(
        {
            "delivery_days": dates.floor_days(purchased, delivered),
            "is_late": F.coalesce(late, F.lit(False)).cast("int"),
            "purchase_month": dates.month_label(purchased),
        }
    )


def clean_orders(orders: DataFrame, distinct: Distinct = drop_duplicate_rows) -> DataFrame:
    return with_delivery_kpis(parse_order_timestamps(distinct(orders)))


def keep_valid_prices(items: DataFrame) -> DataFrame:
    """Keep price > 0 and freight >= 0; a missing amount fails both tests."""
    return items.filter((F.col("price") > 0) & (F.col("freight_value") >= 0))


def clean_order_items(items: DataFrame, distinct: Distinct = drop_duplicate_rows) -> DataFrame:
    # The filter keeps or drops equal rows together, so it may run before the shuffle
    # that removes duplicates.
    return distinct(keep_valid_prices(items))


def fill_category(products: DataFrame) -> DataFrame:
    return products.fillna(UNKNOWN_CATEGORY, ["product_category_name"])


def translate_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Add the English category; NULL where the translation has none.

    Neither side is hinted: Spark broadcasts the translation when its measured size
    allows, and otherwise joins by shuffle with skew splitting. Repeated keys in the
    translation repeat products; the product key audit reports them.
    """
    english = translation.select("product_category_name", "product_category_name_english")
    joined = products.join(english, "product_category_name", "left")
    return joined.select(*products.columns, "product_category_name_english")


def clean_products(
    products: DataFrame, translation: DataFrame, distinct: Distinct = drop_duplicate_rows
) -> DataFrame:
    return translate_category(fill_category(distinct(products)), translation).withColumnsRenamed(
        PRODUCT_RENAMES
    )


def clean_all(raw: Tables, distinct: Distinct = drop_duplicate_rows) -> Tables:
    """All six staging tables; reviews may still repeat a ``review_id``.

    Pass ``without_copies`` where the tables (but for the translation) went through
    ``count_copies``.
    """
    cleaned = {
        "orders": clean_orders(raw["orders"], distinct),
        "order_items": clean_order_items(raw["order_items"], distinct),
        "products": clean_products(raw["products"], raw["category_translation"], distinct),
        **{name: distinct(raw[name]) for name in ("customers", "payments", "reviews")},
    }
    return {name: cleaned[name] for name in STAGING_TABLES}
