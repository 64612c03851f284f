"""The same results in DuckDB SQL, written the direct way.

Everything here takes the plain route (row-level joins with their fan-out, COUNT DISTINCT,
self-joins), so it shares no shortcut with the Spark plans it checks. Rates and
means use whole-number arithmetic because DuckDB divides decimals as doubles.
"""

from __future__ import annotations

import re

# --- exact arithmetic -------------------------------------------------------------


def pct(part: str, whole: str, precision: int = 10) -> str:
    """100 * part / whole, half-up to two decimals, for non-negative whole numbers."""
    return (
        f"cast(((20000 * ({part}) + ({whole})) // nullif(2 * ({whole}), 0)) * 0.01 "
        f"as decimal({precision},2))"
    )


def mean_of(value: str, digits: int = 0) -> str:
    """Average to six decimals of a number with ``digits`` decimals, half away from zero."""
    scaled = f"cast(({value}) * {10 ** digits} as bigint)"
    step = 2 * 10 ** (6 - digits)
    total, rows = f"sum({scaled})", f"count({value})"
    return (
        f"cast(sign({total}) * (({step} * abs({total}) + {rows}) // nullif(2 * {rows}, 0)) "
        f"* 0.000001 as decimal(14,6))"
    )


def whole(value: str) -> str:
    return f"cast({value} as bigint)"


def money(value: str) -> str:
    return f"cast(sum({value}) as decimal(20,2))"


# --- tables -----------------------------------------------------------------------


def _after(seconds: str) -> str:
    return f"o_orderdate + ({seconds}) * INTERVAL '1' SECOND"


_PURCHASED = "o_orderkey % 86400"
_APPROVED = f"{_PURCHASED} + 3600 * (o_orderkey % 37)"
_CARRIED = f"{_APPROVED} + 3600 * ((o_orderkey * 7) % 97)"
_RECEIVED = f"{_CARRIED} + 3600 * ((o_orderkey * 11) % 613)"

# Text that stands for a missing value, and text that only looks like it.
TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
ALIKE = ("na", "Null", " NA", "none", "-", "0")
TOKEN_LIST, ALIKE_LIST = str(list(TOKENS)), str(list(ALIKE))

_CUSTOMERS = """
        SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
               'CITY_' || cast(c_custkey % 101 AS varchar) AS customer_city,
               CASE WHEN c_custkey % 251 = 5 THEN 'ST_FEW'
                    ELSE 'ST_' || cast(c_custkey % 20 AS varchar) END AS customer_state
        FROM customer"""

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

CTES = {
    "part_categories": """
        SELECT *, CASE WHEN p_partkey % 499 IN (7, 207, 407)
                           THEN 'RARE_' || cast(p_partkey % 499 AS varchar)
                       ELSE p_type || '_' || cast(p_partkey % 3 AS varchar) END AS category
        FROM part""",
    "base_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                                  WHEN 'P' THEN 'canceled' END AS order_status,
               {_after(_PURCHASED)} AS order_purchase_timestamp,
               {_after(_APPROVED)} AS order_approved_at,
               {_after(_CARRIED)} AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 211 <> 0
                    THEN {_after(_RECEIVED)} END AS order_delivered_customer_date,
               o_orderdate + (16 + o_custkey % 20) * INTERVAL '1' DAY
                   AS order_estimated_delivery_date
        FROM orders""",
    "s_orders": """
        SELECT *,
               cast(floor((epoch_us(order_delivered_customer_date)
                           - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS integer)
                   AS delivery_days,
               CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
                    THEN 1 ELSE 0 END AS is_late,
               strftime(order_purchase_timestamp, '%Y-%m') AS purchase_month
        FROM base_orders""",
    "s_items": """
        SELECT CASE WHEN l_orderkey % 1009 = 17 THEN -l_orderkey ELSE l_orderkey END AS order_id,
               l_linenumber AS order_item_id,
               CASE WHEN l_partkey % 887 = 5 THEN -l_partkey ELSE l_partkey END AS product_id,
               CASE WHEN l_orderkey % 7 = 3 AND l_orderkey * 11 % 613 < 200 AND l_suppkey % 4 = 2
                        THEN 700000000 + l_suppkey % 3
                    WHEN l_suppkey % 4 = 0 THEN l_suppkey * 100000 + l_partkey % 97
                    WHEN l_suppkey % 4 = 1 THEN l_suppkey * 100000 + l_partkey % 7
                    ELSE l_suppkey END AS seller_id,
               cast(l_extendedprice AS decimal(10,2)) AS price,
               cast(l_quantity + l_tax AS decimal(10,2)) AS freight_value
        FROM lineitem""",
    "s_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 13 = 0 THEN 'unknown' ELSE category END
                   AS product_category_name,
               CASE WHEN p_partkey % 13 <> 0 AND NOT starts_with(category, 'PROMO')
                    THEN 'en_' || lower(category) END AS product_category_name_english
        FROM part_categories""",
    "all_customers": _CUSTOMERS,
    "s_customers": f"{_CUSTOMERS} WHERE c_custkey % 199 <> 11",
    "s_payments": """
        SELECT CASE WHEN o_orderkey % 1013 = 9 THEN -o_orderkey ELSE o_orderkey END AS order_id,
               n AS payment_sequential
        FROM orders CROSS JOIN (VALUES (1), (2)) AS numbers(n)
        WHERE n = 1 OR o_orderkey % 5 = 0""",
    "base_reviews": """
        SELECT event_id - (CASE WHEN event_id % 50 = 49 THEN 1 ELSE 0 END) AS review_id,
               event_id - (CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) AS order_id,
               CASE WHEN (event_id - (CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END)) % 7 = 3
                        THEN 5
                    WHEN event_type = 'error' THEN 1 WHEN event_type = 'click' THEN 4
                    ELSE 5 END AS review_score
        FROM events""",
    "s_reviews": """
        SELECT review_id, kept.order_id AS order_id, kept.review_score AS review_score
        FROM (SELECT review_id,
                     arg_min({'order_id': order_id, 'review_score': review_score},
                             (order_id, review_score)) AS kept
              FROM base_reviews GROUP BY review_id)""",
    # Raw tables: text timestamps, refused amounts, repeated rows.
    "raw_orders": f"""
        SELECT order_id, customer_id, order_status,
               {', '.join(f'cast({name} AS varchar) AS {name}' for name in ORDER_TIMES)}
        FROM base_orders CROSS JOIN range(2) AS copies(n) WHERE n = 0 OR order_id % 100 = 0""",
    "raw_items": """
        SELECT order_id, order_item_id, product_id, seller_id,
               CASE fault WHEN 1 THEN NULL WHEN 2 THEN 0 WHEN 3 THEN -price ELSE price END
                   AS price,
               CASE fault WHEN 4 THEN NULL WHEN 5 THEN -freight_value ELSE freight_value END
                   AS freight_value
        FROM s_items CROSS JOIN range(6) AS faults(fault) CROSS JOIN range(2) AS copies(n)
        WHERE (fault = 0 OR order_id % 29 = fault) AND (n = 0 OR order_id % 101 = 0)""",
    "raw_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 13 <> 0 THEN category END AS product_category_name,
               cast(length(p_name) AS integer) AS product_name_lenght,
               cast(length(p_brand) AS integer) AS product_description_lenght
        FROM part_categories CROSS JOIN range(2) AS copies(n)
        WHERE n = 0 OR p_partkey % 10 = 0""",
    "raw_customers": """
        SELECT c.* FROM s_customers c CROSS JOIN range(2) AS copies(n)
        WHERE n = 0 OR customer_id % 10 = 0""",
    "all_raw_customers": """
        SELECT c.* FROM all_customers c CROSS JOIN range(2) AS copies(n)
        WHERE n = 0 OR customer_id % 10 = 0""",
    "raw_payments": """
        SELECT p.* FROM s_payments p CROSS JOIN range(2) AS copies(n)
        WHERE n = 0 OR order_id % 103 = 0""",
    "raw_reviews": """
        SELECT r.* FROM base_reviews r CROSS JOIN range(2) AS copies(n)
        WHERE n = 0 OR review_id % 107 = 0""",
    # Keys with NULL, for the checks that must find them.
    "f_orders": """
        SELECT * REPLACE (CASE WHEN order_id % 1499 = 3 THEN NULL ELSE order_id END AS order_id)
        FROM s_orders""",
    "f_customers": """
        SELECT * REPLACE (CASE WHEN customer_id % 601 = 7 THEN NULL ELSE customer_id END
                              AS customer_id)
        FROM s_customers""",
    "f_products": """
        SELECT * REPLACE (CASE WHEN product_id % 701 = 11 THEN NULL ELSE product_id END
                              AS product_id)
        FROM s_products""",
    "f_items": """
        SELECT * REPLACE (CASE WHEN order_id % 1511 = 5 THEN NULL ELSE order_id END AS order_id,
                          CASE WHEN product_id % 797 = 3 THEN NULL ELSE order_item_id END
                              AS order_item_id)
        FROM s_items""",
    "f_payments": "SELECT * FROM s_payments",
    "f_reviews": "SELECT * FROM s_reviews",
    "order_text": f"""
        SELECT order_id,
               CASE WHEN order_id % 41 < {len(TOKENS)} THEN ({TOKEN_LIST})[order_id % 41 + 1]
                    WHEN order_id % 41 < {len(TOKENS) + len(ALIKE)}
                        THEN ({ALIKE_LIST})[order_id % 41 - {len(TOKENS)} + 1]
                    ELSE order_status END AS order_status,
               CASE WHEN order_id % 67 < {len(TOKENS)} THEN ({TOKEN_LIST})[order_id % 67 + 1]
                    WHEN order_id % 67 < {len(TOKENS) + len(ALIKE)}
                        THEN ({ALIKE_LIST})[order_id % 67 - {len(TOKENS)} + 1]
                    ELSE cast(order_approved_at AS varchar) END AS order_approved_at,
               cast(order_delivered_customer_date AS varchar) AS order_delivered_customer_date
        FROM base_orders""",
    # Marts.
    "sales": """
        SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_city,
               c.customer_state, o.order_status, o.order_purchase_timestamp, o.purchase_month,
               i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
               p.product_category_name,
               coalesce(p.product_category_name_english, 'unknown')
                   AS product_category_name_english,
               r.review_score, o.delivery_days, o.is_late
        FROM s_items i
        JOIN s_orders o USING (order_id)
        JOIN s_customers c USING (customer_id)
        LEFT JOIN s_products p USING (product_id)
        LEFT JOIN s_reviews r USING (order_id)""",
    "monthly": f"""
        SELECT purchase_month,
               count(DISTINCT order_id) AS total_orders,
               count(DISTINCT customer_unique_id) AS unique_customers,
               {money('price')} AS product_revenue,
               {money('freight_value')} AS freight_revenue,
               {money('price + freight_value')} AS total_revenue,
               {mean_of('review_score')} AS avg_review_score,
               {mean_of('delivery_days')} AS avg_delivery_days,
               {whole('sum(is_late)')} AS late_order_items,
               count(*) AS total_order_items,
               {pct('sum(is_late)', 'count(*)', 5)} AS late_item_rate_pct
        FROM sales WHERE order_status = 'delivered' GROUP BY purchase_month""",
    "delivery": """
        SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_city,
               c.customer_state, o.order_status, o.order_purchase_timestamp,
               o.order_approved_at, o.order_delivered_carrier_date,
               o.order_delivered_customer_date, o.order_estimated_delivery_date,
               o.delivery_days, o.is_late,
               cast(date_diff('day', o.order_purchase_timestamp, o.order_approved_at)
                    AS integer) AS approval_days,
               cast(date_diff('day', o.order_approved_at, o.order_delivered_carrier_date)
                    AS integer) AS handling_days,
               cast(date_diff('day', o.order_delivered_carrier_date,
                              o.order_delivered_customer_date) AS integer)
                   AS carrier_delivery_days,
               cast(date_diff('day', o.order_estimated_delivery_date,
                              o.order_delivered_customer_date) AS integer) AS delay_days,
               r.review_score
        FROM s_orders o
        LEFT JOIN s_customers c USING (customer_id)
        LEFT JOIN s_reviews r USING (order_id)
        WHERE o.order_status = 'delivered'""",
    "buckets": """
        SELECT * FROM (VALUES (-100000, -7, 'Early by 7+ days', 1),
                              (-6, -1, 'Early by 1-6 days', 2),
                              (0, 0, 'Delivered on estimated date', 3),
                              (1, 3, 'Late by 1-3 days', 4),
                              (4, 7, 'Late by 4-7 days', 5),
                              (8, 100000, 'Late by 8+ days', 6))
            AS b(low_day, high_day, delay_bucket, delay_bucket_sort)""",
    "impact": """
        SELECT d.order_id, d.customer_unique_id, d.customer_state, d.order_purchase_timestamp,
               d.delivery_days, d.delay_days, d.is_late, d.review_score,
               CASE d.is_late WHEN 1 THEN 'Late' WHEN 0 THEN 'On Time or Early'
                              ELSE 'Unknown' END AS delivery_status,
               coalesce(b.delay_bucket, 'Unknown') AS delay_bucket,
               cast(coalesce(b.delay_bucket_sort, 99) AS integer) AS delay_bucket_sort,
               cast(d.review_score <= 2 AS integer) AS is_low_review,
               cast(d.review_score >= 4 AS integer) AS is_high_review
        FROM delivery d LEFT JOIN buckets b ON d.delay_days BETWEEN b.low_day AND b.high_day
        WHERE d.review_score IS NOT NULL""",
    "state_impact": f"""
        SELECT customer_state, count(DISTINCT order_id) AS total_orders,
               {mean_of('delivery_days')} AS avg_delivery_days,
               {mean_of('delay_days')} AS avg_delay_days,
               {pct('sum(is_late)', 'count(*)')} AS late_delivery_rate_pct,
               {mean_of('review_score')} AS avg_review_score,
               {pct('sum(is_low_review)', 'count(*)')} AS low_review_rate_pct,
               sum(is_late) AS late_rows, count(*) AS all_rows, sum(review_score) AS score_sum
        FROM impact GROUP BY customer_state HAVING count(DISTINCT order_id) >= 100""",
    # Thresholds on the unrounded rate and mean, compared as whole numbers.
    "state_risk": """
        SELECT * EXCLUDE (late_rows, all_rows, score_sum),
               CASE WHEN 100 * late_rows >= 15 * all_rows AND score_sum < 4 * all_rows
                        THEN 'High Risk'
                    WHEN 100 * late_rows >= 10 * all_rows OR score_sum < 4 * all_rows
                        THEN 'Medium Risk'
                    ELSE 'Low Risk' END AS logistics_risk_segment
        FROM state_impact""",
    "buyers": """
        SELECT o.order_id, o.customer_id, c.customer_unique_id, o.order_status,
               o.order_purchase_timestamp,
               cast(date_trunc('month', o.order_purchase_timestamp) AS date) AS purchase_month,
               c.customer_city, c.customer_state
        FROM s_orders o JOIN s_customers c USING (customer_id)
        WHERE o.order_status = 'delivered' AND o.order_purchase_timestamp IS NOT NULL""",
    "first_months": """
        SELECT customer_unique_id, min(purchase_month) AS cohort_month
        FROM buyers GROUP BY customer_unique_id""",
    "cohorts": """
        SELECT b.customer_unique_id, b.order_id, b.purchase_month, f.cohort_month,
               cast(date_diff('month', f.cohort_month, b.purchase_month) AS integer)
                   AS cohort_index,
               b.customer_state
        FROM buyers b JOIN first_months f USING (customer_unique_id)""",
    "cohort_cells": """
        SELECT cohort_month, cohort_index,
               count(DISTINCT customer_unique_id) AS retained_customers
        FROM cohorts GROUP BY ALL""",
    "retention": f"""
        SELECT n.cohort_month, n.cohort_index, z.retained_customers AS cohort_size,
               n.retained_customers,
               {pct('n.retained_customers', 'z.retained_customers')} AS retention_rate_pct
        FROM cohort_cells n
        JOIN cohort_cells z ON z.cohort_month = n.cohort_month AND z.cohort_index = 0""",
    "order_counts": """
        SELECT customer_unique_id, count(DISTINCT order_id) AS order_count
        FROM buyers GROUP BY customer_unique_id""",
}


def _group_kpis(key: str, extra: str = "") -> str:
    return f"""
        SELECT {key}, count(DISTINCT order_id) AS total_orders, count(*) AS total_order_items,
               count(DISTINCT customer_unique_id) AS unique_customers,
               {money('price')} AS product_revenue,
               {money('freight_value')} AS freight_revenue,
               {money('price + freight_value')} AS total_revenue,
               {mean_of('price', 2)} AS avg_item_price,
               {mean_of('freight_value', 2)} AS avg_freight_value,
               {mean_of('review_score')} AS avg_review_score,
               {mean_of('delivery_days')} AS avg_delivery_days,
               {pct('sum(is_late)', 'count(*)')} AS late_item_rate_pct{extra}
        FROM sales WHERE order_status = 'delivered' GROUP BY {key}"""


CTES["categories"] = _group_kpis("product_category_name_english")
CTES["sellers"] = _group_kpis(
    "seller_id",
    f", {pct('count(*) FILTER (review_score <= 2)', 'count(*)')} AS low_review_item_rate_pct",
)
CTES["segments"] = """
        SELECT * EXCLUDE (avg_item_price, avg_freight_value),
               CASE WHEN total_orders >= 50 AND total_revenue >= 10000
                         AND (coalesce(avg_review_score < 4, false) OR late_item_rate_pct >= 15
                              OR low_review_item_rate_pct >= 20) THEN 'High Revenue / High Risk'
                    WHEN total_orders >= 50 AND avg_review_score >= 4.5
                         AND late_item_rate_pct < 10 THEN 'Reliable Seller'
                    WHEN total_orders < 10 THEN 'Low Volume Seller'
                    ELSE 'Standard Seller' END AS seller_segment
        FROM sellers"""

# Buyers and cohorts of all customers.
_OF_ALL = {"s_customers": "all_customers", "buyers": "all_buyers", "first_months": "all_first_months"}
for _name in ("buyers", "first_months", "cohorts"):
    CTES[f"all_{_name}"] = re.sub(
        rf"\b({'|'.join(_OF_ALL)})\b", lambda found: _OF_ALL[found[0]], CTES[_name]
    )

# --- queries ----------------------------------------------------------------------

# Columns and Spark type names of the raw tables, in order.
RAW_COLUMNS = {
    "orders": [
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("order_status", "string"),
        *[(name, "string") for name in ORDER_TIMES],
    ],
    "order_items": [
        ("order_id", "bigint"),
        ("order_item_id", "int"),
        ("product_id", "bigint"),
        ("seller_id", "bigint"),
        ("price", "decimal(10,2)"),
        ("freight_value", "decimal(10,2)"),
    ],
    "products": [
        ("product_id", "bigint"),
        ("product_category_name", "string"),
        ("product_name_lenght", "int"),
        ("product_description_lenght", "int"),
    ],
    "customers": [
        ("customer_id", "bigint"),
        ("customer_unique_id", "bigint"),
        ("customer_city", "string"),
        ("customer_state", "string"),
    ],
    "payments": [("order_id", "bigint"), ("payment_sequential", "int")],
    "reviews": [("review_id", "bigint"), ("order_id", "bigint"), ("review_score", "int")],
}
RAW_CTE = {name: f"raw_{'items' if name == 'order_items' else name}" for name in RAW_COLUMNS}
STAGING_CTE = {name: f"s_{'items' if name == 'order_items' else name}" for name in RAW_COLUMNS}

KEYS = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id"],
}
ORPHANS = (
    ("orders_without_customer", "orders", "customers", "customer_id"),
    ("order_items_without_order", "items", "orders", "order_id"),
    ("order_items_without_product", "items", "products", "product_id"),
    ("payments_without_order", "payments", "orders", "order_id"),
)
NULLS = (
    ("null_order_id", "orders", "order_id"),
    ("null_customer_id", "customers", "customer_id"),
    ("null_product_id", "products", "product_id"),
    ("null_order_items_order_id", "items", "order_id"),
    ("null_order_item_id", "items", "order_item_id"),
)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _profile(table: str, cte: str = "") -> str:
    return _union(
        [
            f"SELECT {position} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
            f"count({name}) AS non_null_count, count(*) - count({name}) AS missing_count "
            f"FROM {cte or RAW_CTE[table]}"
            for position, (name, kind) in enumerate(RAW_COLUMNS[table], start=1)
        ]
    )


def _duplicates(table: str) -> str:
    cte = RAW_CTE[table]
    return (
        f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {cte}) AS row_count, "
        f"count(*) AS distinct_rows, "
        f"(SELECT count(*) FROM {cte}) - count(*) AS duplicate_rows "
        f"FROM (SELECT DISTINCT * FROM {cte})"
    )


def _key_audit(table: str, checked: str) -> str:
    columns, cte = KEYS[table], checked + STAGING_CTE[table].removeprefix("s_")
    missing = " OR ".join(f"{name} IS NULL" for name in columns)
    names = ", ".join(columns)
    return f"""
        SELECT '{table}' AS table_name, '{names}' AS key_columns, a.row_count,
               a.null_key_rows, d.duplicate_keys,
               a.null_key_rows = 0 AND d.duplicate_keys = 0 AS passed
        FROM (SELECT count(*) AS row_count, count(*) FILTER ({missing}) AS null_key_rows
              FROM {cte}) a,
             (SELECT count(*) AS duplicate_keys
              FROM (SELECT {names} FROM {cte} WHERE NOT ({missing})
                    GROUP BY {names} HAVING count(*) > 1)) d"""


def _matrix() -> str:
    months = ", ".join(
        f"max(retention_rate_pct) FILTER (cohort_index = {i}) AS month_{i}" for i in range(13)
    )
    return f"SELECT cohort_month, cohort_size, {months} FROM retention GROUP BY ALL"


def _bodies(checked: str = "f_", of_all: str = "all_") -> dict[str, str]:
    """The queries; ``checked`` is the prefix of the tables whose keys are checked.

    ``of_all`` is the prefix of the tables of all customers.
    """
    nullified = ", ".join(
        f"CASE WHEN {name} NOT IN ({str(list(TOKENS))[1:-1]}) THEN {name} END AS {name}"
        for name in ("order_status", "order_approved_at", "order_delivered_customer_date")
    )
    category = "product_category_name_english"
    return {
        **{f"profile_{table}": _profile(table) for table in RAW_COLUMNS},
        "profile_customers": _profile("customers", "all_raw_customers"),
        "duplicate_rows": _union([_duplicates(table) for table in RAW_COLUMNS]),
        "profile_counted": _union(
            [f"SELECT '{table}' AS table_name, * FROM ({_profile(table)})" for table in RAW_COLUMNS]
        ),
        "nullify_tokens": f"SELECT order_id, {nullified} FROM order_text",
        "dedup_rows": "SELECT DISTINCT * FROM raw_reviews",
        "clean_orders": "SELECT * FROM s_orders",
        "clean_order_items": """
            SELECT DISTINCT order_id, order_item_id, product_id, seller_id,
                   cast(price AS decimal(10,2)) AS price,
                   cast(freight_value AS decimal(10,2)) AS freight_value
            FROM raw_items WHERE price > 0 AND freight_value >= 0""",
        "clean_products": """
            SELECT DISTINCT s.product_id, s.product_category_name,
                   r.product_name_lenght AS product_name_length,
                   r.product_description_lenght AS product_description_length,
                   s.product_category_name_english
            FROM raw_products r JOIN s_products s USING (product_id)""",
        "clean_customers": "SELECT DISTINCT * FROM raw_customers",
        "clean_payments": "SELECT DISTINCT * FROM raw_payments",
        "dq_review_duplicates": """
            SELECT review_id, count(*) AS row_count FROM base_reviews
            GROUP BY review_id HAVING count(*) > 1""",
        "dedup_reviews": "SELECT * FROM s_reviews",
        "dq_row_counts": _union(
            [
                f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
                for name, cte in STAGING_CTE.items()
            ]
        ),
        "dq_null_keys": _union(
            [
                f"SELECT '{name}' AS check_name, count(*) AS violations FROM {checked}{cte} "
                f"WHERE {column} IS NULL"
                for name, cte, column in NULLS
            ]
        ),
        "dq_orphans": _union(
            [
                f"SELECT '{name}' AS check_name, count(*) AS violations FROM {checked}{child} x "
                f"WHERE NOT EXISTS (SELECT 1 FROM {checked}{parent} y WHERE y.{column} = x.{column})"
                for name, child, parent, column in ORPHANS
            ]
        ),
        "dq_key_audit": _union([_key_audit(table, checked) for table in KEYS]),
        "sales_order_items": "SELECT * FROM sales",
        "monthly_kpis": "SELECT * FROM monthly",
        "category_performance": "SELECT * FROM categories",
        "seller_performance": "SELECT * FROM sellers",
        "seller_risk_segments": "SELECT * FROM segments",
        "delivery_performance": "SELECT * FROM delivery",
        "delivery_review_impact": "SELECT * FROM impact",
        "state_logistics_risk": "SELECT * FROM state_risk",
        "customer_orders": "SELECT * FROM buyers",
        "customer_cohorts": f"SELECT * FROM {of_all}cohorts",
        "cohort_retention": "SELECT * FROM retention",
        "cohort_retention_matrix": _matrix(),
        "delivery_performance_top20": """
            SELECT * FROM delivery ORDER BY order_id, review_score NULLS FIRST LIMIT 20""",
        "state_delivery_kpis": f"""
            SELECT customer_state, count(DISTINCT order_id) AS delivered_orders,
                   {mean_of('delivery_days')} AS avg_delivery_days,
                   {mean_of('delay_days')} AS avg_delay_days,
                   {pct('sum(is_late)', 'count(*)', 5)} AS late_delivery_rate_pct,
                   {mean_of('review_score')} AS avg_review_score
            FROM delivery GROUP BY customer_state""",
        "category_top10_revenue": f"""
            SELECT {category}, total_orders, total_order_items, total_revenue,
                   avg_review_score, avg_delivery_days, late_item_rate_pct
            FROM categories ORDER BY total_revenue DESC, {category} LIMIT 10""",
        "category_worst_reviewed": f"""
            SELECT {category}, total_orders, total_revenue, avg_review_score,
                   late_item_rate_pct, avg_delivery_days
            FROM categories WHERE total_orders >= 100
            ORDER BY avg_review_score NULLS FIRST, {category} LIMIT 10""",
        "seller_top20_revenue": """
            SELECT * FROM sellers ORDER BY total_revenue DESC, seller_id LIMIT 20""",
        "seller_top20_established": """
            SELECT seller_id, total_orders, total_order_items, total_revenue,
                   avg_review_score, late_item_rate_pct, low_review_item_rate_pct
            FROM sellers WHERE total_orders >= 50
            ORDER BY total_revenue DESC, seller_id LIMIT 20""",
        "seller_segment_summary": f"""
            SELECT seller_segment, count(*) AS seller_count,
                   {money('total_revenue')} AS segment_revenue,
                   {mean_of('avg_review_score', 6)} AS avg_segment_review_score,
                   {mean_of('late_item_rate_pct', 2)} AS avg_late_item_rate_pct
            FROM segments GROUP BY seller_segment""",
        "delivery_status_summary": f"""
            SELECT delivery_status, count(DISTINCT order_id) AS total_orders,
                   {mean_of('review_score')} AS avg_review_score,
                   {whole('sum(is_low_review)')} AS low_review_orders,
                   {pct('sum(is_low_review)', 'count(*)')} AS low_review_rate_pct
            FROM impact GROUP BY delivery_status""",
        "review_impact_top20": """
            SELECT * FROM impact
            ORDER BY order_purchase_timestamp NULLS FIRST, order_id, review_score LIMIT 20""",
        "delay_bucket_summary": f"""
            SELECT delay_bucket, count(DISTINCT order_id) AS total_orders,
                   {mean_of('review_score')} AS avg_review_score,
                   {pct('sum(is_low_review)', 'count(*)')} AS low_review_rate_pct,
                   {pct('sum(is_high_review)', 'count(*)')} AS high_review_rate_pct
            FROM impact GROUP BY delay_bucket, delay_bucket_sort""",
        "state_review_impact": """
            SELECT * EXCLUDE (late_rows, all_rows, score_sum) FROM state_impact""",
        "state_logistics_risk_ranked": "SELECT * FROM state_risk",
        "customer_orders_top20": """
            SELECT * FROM buyers ORDER BY order_purchase_timestamp, order_id LIMIT 20""",
        "delivered_order_count": f"SELECT count(*) AS delivered_order_count FROM {of_all}buyers",
        "cohort_counts": "SELECT * FROM cohort_cells",
        "customer_cohorts_top20": """
            SELECT * FROM cohorts ORDER BY cohort_month, customer_unique_id, order_id LIMIT 20""",
        "repeat_customer_rate": f"""
            SELECT count(DISTINCT customer_unique_id) AS total_customers,
                   count(DISTINCT customer_unique_id) FILTER (order_count > 1)
                       AS repeat_customers,
                   {pct('count(DISTINCT customer_unique_id) FILTER (order_count > 1)',
                        'count(DISTINCT customer_unique_id)')} AS repeat_customer_rate_pct
            FROM order_counts""",
        "cohort_sizes": "SELECT * FROM retention WHERE cohort_index = 0",
        "order_count_histogram": """
            SELECT order_count, count(*) AS customer_count
            FROM order_counts GROUP BY order_count""",
    }


def _with_needed(body: str, given: frozenset[str] = frozenset()) -> str:
    """Prefix ``body`` with the common tables it reaches, except those ``given``."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        found = (words & CTES.keys()) - needed - given
        needed |= found
        pending.extend(CTES[name] for name in found)
    tables = [f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed]
    return f"WITH {', '.join(tables)} {body}" if tables else body


def oracle_queries() -> dict[str, str]:
    return {name: _with_needed(body) for name, body in _bodies().items()}


def staged_queries() -> dict[str, str]:
    """The same queries for a connection that already has the staging tables."""
    given = frozenset(STAGING_CTE.values())
    return {name: _with_needed(body, given) for name, body in _bodies("s_", "").items()}
