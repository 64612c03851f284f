"""Copies of the star-schema tables under new keys, for timing at a larger size.

    python -m checks.enlarge data_dir out_dir copies [hot]

With ``hot`` a third of the items belong to one order and a third of the orders to one
customer.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import build_session
from mercato.sources.star import SOURCE_SCHEMAS

# The key columns of each table and the distance between the keys of two copies.
KEYS = {
    "customer": {"c_custkey": 10_000_000},
    "part": {"p_partkey": 10_000_000},
    "orders": {"o_orderkey": 100_000_000, "o_custkey": 10_000_000},
    "lineitem": {"l_orderkey": 100_000_000, "l_partkey": 10_000_000},
    "events": {"event_id": 100_000_000},
}
# Columns with a hot key, and that key.
HOT = {"orders": ("o_custkey", 1), "lineitem": ("l_orderkey", 1)}


def enlarged(spark: SparkSession, data_dir: str, table: str, copies: int, hot: bool) -> DataFrame:
    df = spark.read.schema(SOURCE_SCHEMAS[table]).parquet(f"{data_dir}/{table}.parquet")
    df = df.withColumn("_copy", F.explode(F.array(*map(F.lit, range(copies)))))
    df = df.withColumns({k: F.col(k) + F.col("_copy") * step for k, step in KEYS[table].items()})
    if hot and table in HOT:
        column, key = HOT[table]
        third = F.xxhash64(*df.columns) % 3 == 0
        df = df.withColumn(column, F.when(third, F.lit(key).cast("long")).otherwise(F.col(column)))
    return df.drop("_copy")


def main() -> None:
    data_dir, out_dir, copies = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = build_session("enlarge", "local[8]", 32, {"spark.driver.memory": "8g", "spark.log.level": "ERROR"})
    for table in KEYS:
        large = enlarged(spark, data_dir, table, copies, "hot" in sys.argv[4:])
        large.repartition(32).write.parquet(f"{out_dir}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
