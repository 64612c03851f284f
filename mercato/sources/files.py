"""Reading raw and staged tables, writing staged tables and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.schemas import (
    NULL_TOKENS,
    RAW_FILES,
    RAW_TABLES,
    RAW_TYPES,
    STAGING_TABLES,
    STAGING_TYPES,
    Tables,
)

# Free text with line breaks; reading it whole-file costs the split of that file only.
MULTILINE_TABLES = {"reviews"}

# Tables stored in one directory per value of a column.
PARTITIONED_BY = {"orders": "purchase_month"}


def nullify_tokens(df: DataFrame) -> DataFrame:
    """Turn missing-value text into NULL in every string column."""
    tokens = list(NULL_TOKENS)
    text = [field.name for field in df.schema if field.dataType.simpleString() == "string"]
    return df.withColumns(
        {name: F.when(~F.col(f"`{name}`").isin(tokens), F.col(f"`{name}`")) for name in text}
    )


def _typed(name: str, kind: str) -> Column:
    """The column cast strictly: a value that the type can't hold fails, none is rounded."""
    column = F.col(f"`{name}`")
    value = column.cast(kind)
    if kind == "int" or kind.startswith("decimal"):
        # Whole numbers may be written with a decimal point, as in "7.0".
        exact = column.cast("decimal(38,18)")
        value = exact.cast(kind)
        message = F.concat(F.lit(f"{name} is not a {kind}: "), column)
        value = F.when(exact != value, F.raise_error(message).cast(kind)).otherwise(value)
    return value.alias(name)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the known columns in place; others are carried through unchanged."""
    kinds = {name: types.get(name, "string") for name in df.columns}
    return df.select(
        *[
            F.col(f"`{name}`") if kind == "string" else _typed(name, kind)
            for name, kind in kinds.items()
        ]
    )


def read_csv(
    spark: SparkSession, path: str, types: dict[str, str], multiline: bool = False
) -> DataFrame:
    """Read text columns by header, drop missing-value tokens, then cast strictly.

    A row with more or fewer fields than the header fails, and so does a file whose
    header differs from that of the first. All fields are parsed, so a query that needs
    few columns fails as well.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
    )
    names = reader.csv(path).columns
    text = (
        reader.schema(", ".join(f"`{name}` string" for name in names))
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .csv(path)
    )
    return cast_columns(nullify_tokens(text), types)


def read_raw(
    spark: SparkSession, directory: str, table: str, file_name: str | None = None
) -> DataFrame:
    """A raw table; ``file_name`` (a name, pattern or directory) overrides the default.

    The default is a pattern that must match one file: two would be two distributions.
    """
    path = f"{directory.rstrip('/')}/{file_name or RAW_FILES[table]}"
    if not file_name:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [str(status.getPath()) for status in system.globStatus(hadoop) or []]
        if len(found) != 1:
            raise ValueError(f"{path} matches {len(found)} files: {', '.join(found)}")
    return read_csv(spark, path, RAW_TYPES[table], multiline=table in MULTILINE_TABLES)


def read_raw_all(spark: SparkSession, directory: str) -> Tables:
    return {table: read_raw(spark, directory, table) for table in RAW_TABLES}


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, fmt: str = "parquet"
) -> None:
    """Replace the dataset at ``path``.

    A partitioned write is rebalanced on its column first: small partitions share a
    task and a large one is split, so neither file count nor task size explodes.
    """
    writer = (df.hint("rebalance", partition_by) if partition_by else df).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    elif partition_by:
        writer = writer.partitionBy(partition_by)
    writer.format(fmt).save(path)


def write_staging(tables: Tables, directory: str, fmt: str = "parquet") -> None:
    """Write the staging tables as ``clean_<table>``; the translation is not kept."""
    for table in STAGING_TABLES:
        write_table(
            tables[table],
            staging_path(directory, table, fmt),
            PARTITIONED_BY.get(table) if fmt == "parquet" else None,
            fmt,
        )


def staging_path(directory: str, table: str, fmt: str = "parquet") -> str:
    suffix = ".csv" if fmt == "csv" else ""
    return f"{directory.rstrip('/')}/clean_{table}{suffix}"


def read_staging(
    spark: SparkSession, directory: str, fmt: str = "parquet"
) -> Tables:
    """The staging tables, from Parquet or from cleaned CSV (a file or a directory)."""
    if fmt == "csv":
        return {
            table: read_csv(
                spark,
                staging_path(directory, table, fmt),
                STAGING_TYPES[table],
                multiline=table in MULTILINE_TABLES,
            )
            for table in STAGING_TABLES
        }
    return {table: spark.read.parquet(staging_path(directory, table)) for table in STAGING_TABLES}
