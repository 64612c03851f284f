"""The whole run: raw files, staging tables, checks, marts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import cleaning, profile, quality
from mercato.plans import cohort, delivery, reports, sales
from mercato.schemas import STAGING_TABLES, Tables
from mercato.sources import files

# Results several marts build on, written once per run and read back by the marts.
SHARED = {
    "order_facts": sales.order_facts,
    "customer_orders": cohort.customer_orders,
    "seller_performance": sales.seller_performance,
    "cohort_counts": cohort.cohort_counts,
}

# The marts of each dashboard page and the shared results they use.
PAGES: dict[str, dict] = {
    "executive": {
        "sales_order_items": sales.sales_order_items,
        "monthly_kpis": reports.monthly_kpis,
        "category_performance": sales.category_performance,
    },
    "delivery": {
        "delivery_performance": delivery.delivery_performance,
        "state_delivery_kpis": reports.state_delivery_kpis,
        "state_logistics_risk": reports.state_logistics_risk_ranked,
    },
    "review_impact": {
        "delivery_review_impact": delivery.delivery_review_impact,
        "delivery_status_summary": reports.delivery_status_summary,
        "delay_bucket_summary": reports.delay_bucket_summary,
        "state_review_impact": reports.state_review_impact,
    },
    "cohort": {
        "customer_orders": cohort.customer_orders,
        "customer_cohorts": cohort.customer_cohorts,
        "cohort_retention": reports.cohort_retention,
        "cohort_retention_matrix": reports.cohort_retention_matrix,
        "repeat_customer_rate": reports.repeat_customer_rate,
        "order_count_histogram": reports.order_count_histogram,
    },
    "seller": {
        "seller_performance": sales.seller_performance,
        "seller_risk_segments": sales.seller_risk_segments,
        "seller_segment_summary": reports.seller_segment_summary,
    },
}
PAGE_SHARED = {
    "executive": ("order_facts",),
    "delivery": ("order_facts",),
    "review_impact": ("order_facts",),
    "cohort": ("customer_orders", "cohort_counts"),
    "seller": ("order_facts", "seller_performance"),
}


class KeyViolation(ValueError):
    """A staging table breaks its declared key, so distinct counts would be wrong."""


def require_keys(audit: DataFrame) -> None:
    """Fail unless every declared key holds; six rows at most reach the driver."""
    failed = audit.filter(~F.col("passed")).collect()
    if failed:
        details = "; ".join(
            f"{row.table_name}({row.key_columns}): {row.duplicate_keys} repeated, "
            f"{row.null_key_rows} rows with NULL"
            for row in failed
        )
        raise KeyViolation(details)


def write_quality(tables: Tables, reviews_before: DataFrame, directory: str) -> None:
    checks = {
        "row_counts": quality.row_counts(tables),
        "null_keys": quality.null_keys(tables),
        "orphans": quality.orphans(tables),
        "key_audit": quality.key_audits(tables),
        "review_duplicates": quality.repeated_keys(reviews_before, "review_id"),
    }
    for name, df in checks.items():
        files.write_table(df, f"{directory}/{name}")


def stage(spark: SparkSession, raw_dir: str, out_dir: str) -> Tables:
    """Clean the raw files into ``staging``; profile and check them into ``quality``.

    The files are parsed once and their rows grouped once, into ``distinct``: each row with
    the number of its copies. Profile, duplicate report and cleaning all read that.

    Reviews are written as cleaned first, because the duplicate report needs them, and
    the staging table is then the de-duplicated rest.
    """
    raw = files.read_raw_all(spark, raw_dir)
    for name in STAGING_TABLES:
        files.write_table(cleaning.count_copies(raw[name]), f"{out_dir}/distinct/{name}")
    counted = {name: spark.read.parquet(f"{out_dir}/distinct/{name}") for name in STAGING_TABLES}
    for report, of in (
        ("profile", profile.profile_counted),
        ("duplicate_rows", profile.duplicates_counted),
    ):
        files.write_table(profile.per_table(counted, of), f"{out_dir}/quality/{report}")

    cleaned = cleaning.clean_all({**raw, **counted}, cleaning.without_copies)
    files.write_staging(cleaned, f"{out_dir}/cleaned")
    tables = files.read_staging(spark, f"{out_dir}/cleaned")
    reviews_before = tables["reviews"]
    files.write_table(
        quality.dedup_reviews(reviews_before), f"{out_dir}/staging/reviews"
    )
    tables["reviews"] = spark.read.parquet(f"{out_dir}/staging/reviews")
    write_quality(tables, reviews_before, f"{out_dir}/quality")
    return tables


def shared_dir(spark: SparkSession, out_dir: str) -> str:
    """Where shared results go: the cluster's checkpoint folder, else beside the marts."""
    checkpoints = spark.conf.get("spark.checkpoint.dir", None)
    if checkpoints:
        return f"{checkpoints.rstrip('/')}/mercato-{uuid.uuid4()}"
    return f"{out_dir}/_shared-{uuid.uuid4()}"


def _path(spark: SparkSession, path: str):
    """A path and the file system it is in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    hadoop, system = _path(spark, path)
    system.delete(hadoop, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    path, system = _path(spark, source)
    to, _ = _path(spark, target)
    system.mkdirs(to.getParent())
    if not system.rename(path, to):
        raise OSError(f"{source} could not be moved to {target}")


def publish(spark: SparkSession, draft: str, out_dir: str, names: list[str]) -> None:
    """Put the datasets ``names`` of ``draft`` in the place of those of ``out_dir``.

    Old ones step aside first. If a move fails, all that were there before come back.
    Moves rename; in a store that copies instead, a reader may find a dataset incomplete
    while it is moved.
    """
    aside = f"{out_dir}/_old-{uuid.uuid4()}"
    stepped, placed = [], []
    try:
        for name in names:
            path, system = _path(spark, f"{out_dir}/{name}")
            if system.exists(path):
                _move(spark, f"{out_dir}/{name}", f"{aside}/{name}")
                stepped.append(name)
            _move(spark, f"{draft}/{name}", f"{out_dir}/{name}")
            placed.append(name)
    except BaseException:
        for name in placed:
            _remove(spark, f"{out_dir}/{name}")
        for name in stepped:
            _move(spark, f"{aside}/{name}", f"{out_dir}/{name}")
        raise
    finally:
        _remove(spark, aside)


def write_marts(
    spark: SparkSession, tables: Tables, out_dir: str, pages: Iterable[str] = tuple(PAGES)
) -> None:
    """Write one dataset per mart under ``<out_dir>/<page>/<mart>``.

    Results used by several marts are written once to the shared folder and read back,
    so no join runs twice and a lost executor costs at most the step at hand. All marts are
    written beside the old ones and take their places at the end: a run that fails leaves
    the marts of the run before. Both working folders go in any case.
    """
    pages = list(pages)
    tables = dict(tables)
    keep, draft = shared_dir(spark, out_dir), f"{out_dir}/_draft-{uuid.uuid4()}"
    try:
        for name, build in SHARED.items():
            if any(name in PAGE_SHARED[page] for page in pages):
                files.write_table(build(tables), f"{keep}/{name}")
                tables[name] = spark.read.parquet(f"{keep}/{name}")
        for page in pages:
            for name, build in PAGES[page].items():
                ready = tables[name] if name in tables else build(tables)
                files.write_table(ready, f"{draft}/{page}/{name}")
        publish(spark, draft, out_dir, [f"{page}/{name}" for page in pages for name in PAGES[page]])
    finally:
        _remove(spark, keep)
        _remove(spark, draft)


def run(
    spark: SparkSession, raw_dir: str, out_dir: str, pages: Iterable[str] = tuple(PAGES)
) -> Tables:
    """Raw files to marts; stops before the marts when a declared key is violated."""
    tables = stage(spark, raw_dir, out_dir)
    require_keys(spark.read.parquet(f"{out_dir}/quality/key_audit"))
    write_marts(spark, tables, f"{out_dir}/marts", pages)
    return tables
