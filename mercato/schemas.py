"""Table schemas, keys and file names shared by sources, checks and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame

Tables = dict[str, DataFrame]

STAGING_TABLES = ("orders", "order_items", "products", "customers", "payments", "reviews")
RAW_TABLES = (*STAGING_TABLES, "category_translation")

# Column types of the raw tables once cast. Timestamps stay text
# until the order cleaning parses them; columns not listed stay text throughout.
RAW_TYPES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "string",
        "order_approved_at": "string",
        "order_delivered_carrier_date": "string",
        "order_delivered_customer_date": "string",
        "order_estimated_delivery_date": "string",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "price": "decimal(10,2)",
        "freight_value": "decimal(10,2)",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "int",
        "product_description_lenght": "int",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "payments": {"order_id": "string", "payment_sequential": "int"},
    "reviews": {"review_id": "string", "order_id": "string", "review_score": "int"},
}

# The columns order cleaning parses to timestamps.
ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# Misspelt product columns and their corrected names.
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

# Types of the cleaned tables, for reading them back from text.
STAGING_TYPES: dict[str, dict[str, str]] = {
    **{name: RAW_TYPES[name] for name in ("order_items", "customers", "payments", "reviews")},
    "orders": {
        **RAW_TYPES["orders"],
        **dict.fromkeys(ORDER_TIMESTAMPS, "timestamp_ntz"),
        "delivery_days": "int",
        "is_late": "int",
        "purchase_month": "string",
    },
    "products": {
        **{PRODUCT_RENAMES.get(name, name): kind for name, kind in RAW_TYPES["products"].items()},
        "product_category_name_english": "string",
    },
}

# The key of each staging table.
KEYS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id",),
    "customers": ("customer_id",),
    "products": ("product_id",),
    "order_items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
    "reviews": ("review_id",),
}

# Raw file names. The leading part of a name differs between
# distributions of the data, so it is matched with a wildcard.
RAW_FILES = {
    "orders": "*_orders_dataset.csv",
    "order_items": "*_order_items_dataset.csv",
    "products": "*_products_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
    "customers": "*_customers_dataset.csv",
    "payments": "*_order_payments_dataset.csv",
    "reviews": "*_order_reviews_dataset.csv",
}

# Text that counts as a missing value in a raw file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
