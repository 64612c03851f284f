"""Marketplace tables derived from a star schema of customers, parts, orders and lines.

The star schema has no deliveries and no reviews, so both follow from key arithmetic:
each step of a delivery is a fixed number of hours after the one before, and each
stream event is read as a review of the order that carries its number. Some keys have no
parent, some states and categories few orders, and some sellers only good and punctual ones,
so that every rule of the marts is reached.

``STAGING`` are the cleaned tables. ``RAW`` are the same tables before cleaning:
timestamps are text, and rows the cleaning must remove are mixed in. ``FAULTY`` are the
cleaned tables with NULL in some keys, which the marts refuse and the checks must find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.recode import recoded
from mercato.operators.cleaning import with_delivery_kpis
from mercato.operators.quality import dedup_reviews
from mercato.schemas import NULL_TOKENS, ORDER_TIMESTAMPS, Tables

# The columns read from each source table. Stating them spares a job per
# table that would open the files only to find out their types.
SOURCE_SCHEMAS = {
    "customer": "c_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_tax double",
    "events": "event_id bigint, event_type string",
}

# Order states by their code.
STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}

# The category of a part, three of each type and three with few parts.
CATEGORY = (
    "CASE WHEN p_partkey % 499 IN (7, 207, 407) THEN concat('RARE_', p_partkey % 499) "
    "ELSE concat(p_type, '_', p_partkey % 3) END"
)

# Seconds from midnight of the order date to each step of its delivery.
TO_PURCHASE = "o_orderkey % 86400"
TO_APPROVAL = f"{TO_PURCHASE} + 3600 * (o_orderkey % 37)"
TO_CARRIER = f"{TO_APPROVAL} + 3600 * ((o_orderkey * 7) % 97)"
TO_CUSTOMER = f"{TO_CARRIER} + 3600 * ((o_orderkey * 11) % 613)"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(path)


def all_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state has few."""
    return _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_custkey - c_custkey % 2 AS customer_unique_id",
        "concat('CITY_', c_custkey % 101) AS customer_city",
        "if(c_custkey % 251 = 5, 'ST_FEW', concat('ST_', c_custkey % 20)) AS customer_state",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers are missing, so their orders have none."""
    return all_customers(spark, sf_dir).filter("customer_id % 199 <> 11")


def orders_without_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    def after(seconds: str) -> str:
        return f"timestampadd(SECOND, {seconds}, o_orderdate)"

    received = "o_orderstatus = 'F' AND o_orderkey % 211 <> 0"
    named = _read(spark, sf_dir, "orders").withColumn(
        "order_status", recoded(F.col("o_orderstatus"), STATUS)
    )
    return named.selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "order_status",
        f"{after(TO_PURCHASE)} AS order_purchase_timestamp",
        f"{after(TO_APPROVAL)} AS order_approved_at",
        f"{after(TO_CARRIER)} AS order_delivered_carrier_date",
        f"CASE WHEN {received} THEN {after(TO_CUSTOMER)} END AS order_delivered_customer_date",
        "timestampadd(DAY, 16 + o_custkey % 20, o_orderdate) AS order_estimated_delivery_date",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_delivery_kpis(orders_without_kpis(spark, sf_dir))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines keep their own number, which the source repeats within some orders.

    Some lines have no order or no product. Three sellers take only orders that arrive
    early and are reviewed well.
    """
    return _read(spark, sf_dir, "lineitem").selectExpr(
        "if(l_orderkey % 1009 = 17, -l_orderkey, l_orderkey) AS order_id",
        "l_linenumber AS order_item_id",
        "if(l_partkey % 887 = 5, -l_partkey, l_partkey) AS product_id",
        "CASE WHEN l_orderkey % 7 = 3 AND (l_orderkey * 11) % 613 < 200 AND l_suppkey % 4 = 2 "
        "THEN 700000000 + l_suppkey % 3 "
        "WHEN l_suppkey % 4 = 0 THEN l_suppkey * 100000 + l_partkey % 97 "
        "WHEN l_suppkey % 4 = 1 THEN l_suppkey * 100000 + l_partkey % 7 "
        "ELSE l_suppkey END AS seller_id",
        "cast(l_extendedprice AS decimal(10,2)) AS price",
        "cast(l_quantity + l_tax AS decimal(10,2)) AS freight_value",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _read(spark, sf_dir, "part")
        .selectExpr("p_partkey", f"{CATEGORY} AS category")
        .selectExpr(
            "p_partkey AS product_id",
            "if(p_partkey % 13 = 0, 'unknown', category) AS product_category_name",
            "CASE WHEN p_partkey % 13 <> 0 AND category NOT LIKE 'PROMO%' "
            "THEN concat('en_', lower(category)) END AS product_category_name_english",
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some payments have no order."""
    return _read(spark, sf_dir, "orders").selectExpr(
        "if(o_orderkey % 1013 = 9, -o_orderkey, o_orderkey) AS order_id",
        "explode(if(o_orderkey % 5 = 0, array(1, 2), array(1))) AS payment_sequential",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews before de-duplication: some share a ``review_id``, some share an order."""
    return (
        _read(spark, sf_dir, "events")
        .selectExpr("*", "event_id - if(event_id % 10 = 9, 1, 0) AS order_id")
        .selectExpr(
            "event_id - if(event_id % 50 = 49, 1, 0) AS review_id",
            "order_id",
            "CASE WHEN order_id % 7 = 3 THEN 5 WHEN event_type = 'error' THEN 1 "
            "WHEN event_type = 'click' THEN 4 ELSE 5 END AS review_score",
        )
    )


def distinct_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_reviews(reviews(spark, sf_dir))


def _with_copies(df: DataFrame, repeated: str) -> DataFrame:
    """Rows meeting the condition ``repeated`` appear twice."""
    copies = f"explode(if({repeated}, array(1, 2), array(1))) AS _copy"
    return df.selectExpr("*", copies).drop("_copy")


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of some orders stand beside a copy with an amount that must be refused.

    Faults: 1 no price, 2 zero price, 3 negative price, 4 no freight, 5 negative freight.
    """
    faulty = "if(order_id % 29 BETWEEN 1 AND 5, array(0, cast(order_id % 29 AS int)), array(0))"
    lines = (
        order_items(spark, sf_dir)
        .selectExpr("*", f"explode({faulty}) AS _fault")
        .selectExpr(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "cast(CASE _fault WHEN 1 THEN NULL WHEN 2 THEN 0 WHEN 3 THEN -price ELSE price END "
            "AS decimal(10,2)) AS price",
            "cast(CASE _fault WHEN 4 THEN NULL WHEN 5 THEN -freight_value ELSE freight_value END "
            "AS decimal(10,2)) AS freight_value",
        )
    )
    return _with_copies(lines, "order_id % 101 = 0")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = {name: F.col(name).cast("string") for name in ORDER_TIMESTAMPS}
    return _with_copies(
        orders_without_kpis(spark, sf_dir).withColumns(text), "order_id % 100 = 0"
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        f"if(p_partkey % 13 <> 0, {CATEGORY}, NULL) AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "length(p_brand) AS product_description_lenght",
    )
    return _with_copies(parts, "product_id % 10 = 0")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(customers(spark, sf_dir), "customer_id % 10 = 0")


def all_raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(all_customers(spark, sf_dir), "customer_id % 10 = 0")


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(payments(spark, sf_dir), "order_id % 103 = 0")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(reviews(spark, sf_dir), "review_id % 107 = 0")


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _read(spark, sf_dir, "part")
        .selectExpr(f"{CATEGORY} AS product_category_name")
        .filter("product_category_name NOT LIKE 'PROMO%'")
        .distinct()
        .selectExpr("*", "concat('en_', lower(product_category_name)) AS product_category_name_english")
    )


def order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns of orders as files hold them: some values only say that one is missing.

    Others look alike and are values: a token in other case or with a space.
    """
    tokens = F.array(*map(F.lit, NULL_TOKENS))
    alike = F.array(*map(F.lit, ("na", "Null", " NA", "none", "-", "0")))

    def mixed(name: str, modulus: int):
        at = (F.col("order_id") % modulus).cast("int")
        return (
            F.when(at < F.size(tokens), F.get(tokens, at))
            .when(at < F.size(tokens) + F.size(alike), F.get(alike, at - F.size(tokens)))
            .otherwise(F.col(name).cast("string"))
            .alias(name)
        )

    return orders_without_kpis(spark, sf_dir).select(
        "order_id",
        mixed("order_status", 41),
        mixed("order_approved_at", 67),
        F.col("order_delivered_customer_date").cast("string").alias("order_delivered_customer_date"),
    )


def _nulls(build, **conditions: str):
    """The table of ``build`` with NULL in a column where its condition holds."""

    def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(spark, sf_dir).withColumns(
            {name: F.expr(f"if({condition}, NULL, {name})") for name, condition in conditions.items()}
        )

    return faulty


STAGING = {
    "orders": orders,
    "order_items": order_items,
    "products": products,
    "customers": customers,
    "payments": payments,
    "reviews": distinct_reviews,
}
FAULTY = {
    **STAGING,
    "orders": _nulls(orders, order_id="order_id % 1499 = 3"),
    "customers": _nulls(customers, customer_id="customer_id % 601 = 7"),
    "products": _nulls(products, product_id="product_id % 701 = 11"),
    "order_items": _nulls(
        order_items, order_id="order_id % 1511 = 5", order_item_id="product_id % 797 = 3"
    ),
}
RAW = {
    "orders": raw_orders,
    "order_items": raw_order_items,
    "products": raw_products,
    "customers": raw_customers,
    "payments": raw_payments,
    "reviews": raw_reviews,
    "category_translation": category_translation,
}


def staging_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return {name: build(spark, sf_dir) for name, build in STAGING.items()}


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return {name: build(spark, sf_dir) for name, build in RAW.items()}
