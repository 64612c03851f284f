"""Structure, missing values and duplicate rows of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.cleaning import COPIES, count_copies
from mercato.schemas import Tables


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null and missing counts; one scan."""
    columns = [F.col(f"`{field.name}`") for field in df.schema.fields]
    return _profile(df, F.count(F.lit(1)), [F.count(column) for column in columns])


def profile_counted(counted: DataFrame) -> DataFrame:
    """The profile of the table that ``count_copies`` made ``counted`` of."""
    total = F.coalesce(F.sum(COPIES), F.lit(0))
    columns = [F.col(f"`{name}`") for name in counted.columns if name != COPIES]
    present = [
        F.coalesce(F.sum(F.when(column.isNotNull(), F.col(COPIES))), F.lit(0)) for column in columns
    ]
    return _profile(counted, total, present)


def _profile(df: DataFrame, total: Column, present: list[Column]) -> DataFrame:
    fields = [field for field in df.schema.fields if field.name != COPIES]
    counts = df.agg(
        total.alias("_rows"), *[count.alias(f"_{i}") for i, count in enumerate(present)]
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col(f"_{i}").alias("non_null_count"),
            (F.col("_rows") - F.col(f"_{i}")).alias("missing_count"),
        )
        for i, field in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: all rows, distinct rows, and rows beyond the first copy of each."""
    return duplicates_counted(count_copies(df))


def duplicates_counted(counted: DataFrame) -> DataFrame:
    """``duplicate_rows`` of the table that ``count_copies`` made ``counted`` of."""
    return counted.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicate_rows"),
    )


def per_table(tables: Tables, report) -> DataFrame:
    """``report(df)`` of each table under one another, labelled with the table name."""
    parts = [
        report(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
