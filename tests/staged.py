"""Larger staging tables with hot keys, gaps and NULLs, for checks against brute force.

One order holds a third of the items and another a third of the reviews, one customer a
third of the orders, and one product, seller and state a third of the rows or more. Some
references lead nowhere, some values are missing. Declared keys hold.
"""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from mercato.operators.cleaning import with_delivery_kpis

ORDERS, ITEMS, REVIEWS, CUSTOMERS, PRODUCTS = 1500, 1800, 480, 400, 60
SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
    "order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "price decimal(10,2), freight_value decimal(10,2)",
    "products": "product_id string, product_category_name string, "
    "product_category_name_english string",
    "customers": "customer_id string, customer_unique_id string, customer_city string, "
    "customer_state string",
    "payments": "order_id string, payment_sequential int",
    "reviews": "review_id string, order_id string, review_score int",
}


def _or_none(rng, value, share=0.05):
    return None if rng.random() < share else value


def _rows(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    begin = datetime(2017, 1, 1)

    def money(top):
        return Decimal(rng.randint(1, top)) / 100

    customers = [
        (
            f"c{i}",
            _or_none(rng, "u0" if i % 3 == 0 else f"u{rng.randrange(CUSTOMERS)}", 0.02),
            f"city{i % 7}",
            "ST_0" if i % 3 == 0 else _or_none(rng, f"ST_{i % 5}"),
        )
        for i in range(CUSTOMERS)
    ]
    orders = []
    for i in range(ORDERS):
        bought = begin + timedelta(minutes=rng.randrange(600 * 1440))
        approved = bought + timedelta(minutes=rng.randrange(3000))
        carried = approved + timedelta(minutes=rng.randrange(9000))
        received = carried + timedelta(minutes=rng.randrange(-2000, 40000))
        promised = (bought + timedelta(days=rng.randrange(5, 35))).replace(hour=0, minute=0)
        customer = "c0" if i % 3 == 0 else f"c{rng.randrange(CUSTOMERS + 20)}"
        orders.append(
            (
                f"o{i}",
                _or_none(rng, customer),
                "delivered" if rng.random() < 0.9 else "canceled",
                _or_none(rng, bought, 0.02),
                _or_none(rng, approved),
                _or_none(rng, carried),
                _or_none(rng, received),
                _or_none(rng, promised, 0.02),
            )
        )
    items = [
        (
            "o1" if i % 3 == 0 else _or_none(rng, f"o{rng.randrange(ORDERS + 30)}", 0.02),
            i,
            _or_none(rng, "p1" if i % 3 == 1 else f"p{rng.randrange(PRODUCTS + 5)}"),
            "s1" if i % 3 == 2 else f"s{rng.randrange(40)}",
            money(90000),
            money(3000),
        )
        for i in range(ITEMS)
    ]
    products = [
        (
            f"p{i}",
            "unknown" if i % 3 == 0 else f"cat{i % 8}",
            None if i % 3 == 0 or i % 8 == 7 else f"en_cat{i % 8}",
        )
        for i in range(PRODUCTS)
    ]
    reviews = [
        (
            f"r{i}",
            # o2 is delivered to a customer, o1 is hot on the items' side as well.
            {0: "o2", 1: "o1"}.get(i % 6, _or_none(rng, f"o{rng.randrange(ORDERS + 30)}", 0.02))
            if i % 2 == 0 or i % 6 == 1
            else f"o{rng.randrange(ORDERS)}",
            _or_none(rng, rng.randint(1, 5)),
        )
        for i in range(REVIEWS)
    ]
    payments = [(f"o{i}", n) for i in range(0, ORDERS + 10, 2) for n in range(1, 1 + i % 3)]
    return {
        "orders": orders,
        "order_items": items,
        "products": products,
        "customers": customers,
        "payments": payments,
        "reviews": reviews,
    }


def write(spark, directory, seed: int = 7) -> str:
    """Write the tables as Parquet and return the directory."""
    for name, data in _rows(seed).items():
        df = spark.createDataFrame(data, SCHEMAS[name])
        if name == "orders":
            df = with_delivery_kpis(df)
        df.write.parquet(f"{directory}/{name}")
    return str(directory)


def read(spark, directory) -> dict:
    return {name: spark.read.parquet(f"{directory}/{name}") for name in SCHEMAS}
