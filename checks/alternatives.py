"""Time the plans in use against the plain form of the same result.

    python -m checks.alternatives [data_dir] [shuffle_partitions] [beginnings of names] [hot-reviews]

Broadcast joins are off, as for tables too large to broadcast. Each form runs once
untimed, then three times; the median is printed.
"""

from __future__ import annotations

import statistics
import sys
import time
from unittest.mock import patch

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.plans import cohort, delivery, reports, sales
from mercato.schemas import Tables
from mercato.session import build_session
from mercato.sources import star


def plain_kpis(tables: Tables, group: str, products: bool = True) -> DataFrame:
    """KPIs over the row-level mart with COUNT DISTINCT and plain averages."""
    items = (
        sales.items_with_category(tables)
        if products
        else tables["order_items"].withColumn("product_category_name_english", F.lit(None))
    )
    rows = (
        sales.delivered(tables["orders"])
        .join(tables["customers"], "customer_id")
        .join(items, "order_id")
        .join(tables["reviews"], "order_id", "left")
    )

    def average(name: str):
        return F.avg(F.col(name).cast("decimal(10,2)")).alias(f"avg_{name}")

    return rows.groupBy(group).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        F.count(F.lit(1)).alias("total_order_items"),
        F.sum("price").alias("product_revenue"),
        F.sum("freight_value").alias("freight_revenue"),
        *map(average, ("price", "freight_value", "review_score", "delivery_days")),
        F.count_if(F.col("is_late") == 1).alias("late_order_items"),
        F.count_if(F.col("review_score") <= 2).alias("low_items"),
    )


def window_cohorts(tables: Tables) -> DataFrame:
    """One shuffle by person, but all orders of a person in one task."""
    person = Window.partitionBy(cohort.PERSON)
    first = F.min("purchase_month").over(person)
    return cohort.with_cohort_columns(
        cohort.person_orders(tables).withColumn("cohort_month", first)
    )


def one_shuffle_cohorts(tables: Tables) -> DataFrame:
    """Orders shuffled once, by person and a share of the orders; aggregate and join reuse it.

    There are as many shares as shuffle partitions, so a person with very many orders is
    dealt to all tasks. Both sides use the same columns and a share is never NULL, without
    which Spark would shuffle once for each side.
    """
    shares = int(tables["orders"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.coalesce(F.pmod(F.xxhash64("order_id"), F.lit(shares)), F.lit(0))
    orders = (
        cohort.person_orders(tables)
        .select(cohort.PERSON, "order_id", "purchase_month", "customer_state")
        .repartition(cohort.PERSON, share)
        .withColumn("_share", share)
    )
    first = (
        orders.groupBy(cohort.PERSON, "_share")
        .agg(F.min(F.struct("purchase_month", "customer_state")).alias("_first"))
        .groupBy(cohort.PERSON)
        .agg(F.min("_first").alias("_first"), F.collect_list("_share").alias("_shares"))
        .select(
            cohort.PERSON,
            F.col("_first.purchase_month").alias("cohort_month"),
            F.explode("_shares").alias("_share"),
        )
    )
    return cohort.with_cohort_columns(orders.join(first, [cohort.PERSON, "_share"]))


def with_outer_join(module, build):
    """``build`` with one outer join to reviews, whose optional side is not split."""

    def query(tables: Tables) -> DataFrame:
        with patch.object(module, "left_join_split", lambda a, b, key, **_: a.join(b, key, "left")):
            return build(tables)

    return query


def plain_retention(tables: Tables) -> DataFrame:
    counts = (
        cohort.customer_cohorts(tables)
        .groupBy("cohort_month", "cohort_index")
        .agg(F.count_distinct(cohort.PERSON).alias("retained"))
    )
    size = F.col("retained").alias("size")
    sizes = counts.filter("cohort_index = 0").select("cohort_month", size)
    return counts.join(sizes, "cohort_month")


def plain_buckets(tables: Tables) -> DataFrame:
    return (
        delivery.delivery_review_impact(tables)
        .groupBy("delay_bucket", "delay_bucket_sort")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.avg("review_score").alias("avg_review_score"),
            F.sum("is_low_review").alias("low"),
            F.sum("is_high_review").alias("high"),
        )
    )


CATEGORY = "product_category_name_english"
FORMS = {
    "monthly: in use": sales.monthly_kpis,
    "monthly: row level": lambda t: plain_kpis(t, "purchase_month"),
    "category: in use": sales.category_performance,
    "category: row level": lambda t: plain_kpis(t, CATEGORY),
    "seller: in use": sales.seller_performance,
    "seller: row level": lambda t: plain_kpis(t, "seller_id"),
    "seller: row level, no products": lambda t: plain_kpis(t, "seller_id", products=False),
    "buckets: in use": reports.delay_bucket_summary,
    "buckets: row level": plain_buckets,
    "cohorts: in use": cohort.customer_cohorts,
    "cohorts: window": window_cohorts,
    "cohorts: one shuffle": one_shuffle_cohorts,
    "sales items: in use": sales.sales_order_items,
    "sales items: outer join": with_outer_join(sales, sales.sales_order_items),
    "delivery: in use": delivery.delivery_performance,
    "delivery: outer join": with_outer_join(delivery, delivery.delivery_performance),
    "retention: in use": cohort.cohort_retention,
    "retention: self-join": plain_retention,
}


def with_hot_order(reviews: DataFrame, key: int = 2) -> DataFrame:
    """A third of the reviews belong to one order."""
    third = F.xxhash64("review_id") % 3 == 0
    return reviews.withColumn("order_id", F.when(third, F.lit(key)).otherwise(F.col("order_id")))


def main() -> None:
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    partitions = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = build_session(
        "alternatives",
        "local[8]",
        partitions,
        {
            "spark.driver.memory": "16g",
            "spark.log.level": "ERROR",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    )
    chosen = sys.argv[3] if len(sys.argv) > 3 else ""
    for name, build in FORMS.items():
        if not name.startswith(tuple(chosen.split(","))):
            continue
        times = []
        for _ in range(4):
            begin = time.perf_counter()
            tables = star.staging_tables(spark, data_dir)
            if "hot-reviews" in sys.argv[4:]:
                tables["reviews"] = with_hot_order(tables["reviews"])
            df = build(tables)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        print(f"{name:32} {statistics.median(times[1:]):.2f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
