"""What the physical plans must and must not contain."""

import os
import re
from pathlib import Path

import pytest

from mercato.operators import cleaning, profile
from mercato.plans import cohort, delivery, reports, sales
from mercato.queries import ON_STAGING, all_queries
from mercato.sources import files
from tests import micro, staged

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

# As at scale: no table is small enough to broadcast.
NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return staged.read(spark, staged.write(spark, tmp_path_factory.mktemp("staged")))


def without_initial_plans(text: str) -> str:
    """The plans that ran: an executed plan without those before adaptive changes."""
    kept, above = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :|"))
        if above is not None and depth > above:
            continue
        above = depth if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ON_STAGING)
def test_no_pair_products_and_no_python(tables, conf, name):
    conf(**NO_BROADCAST)
    text = plan(ON_STAGING[name](tables))
    for refused in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Expand"):
        assert refused not in text


def test_status_filter_reaches_the_scan(tables):
    for build in (sales.monthly_kpis, cohort.customer_orders, delivery.delivery_performance):
        assert "EqualTo(order_status,delivered)" in plan(build(tables))


def test_scans_read_only_what_is_used(tables):
    text = plan(sales.monthly_kpis(tables))
    columns = "order_id:string,price:decimal(10,2),freight_value:decimal(10,2)"
    assert f"ReadSchema: struct<{columns}>" in text
    assert "product_category_name" not in text
    assert "customer_city" not in text


def test_sales_kpis_do_not_read_products(tables):
    for build in (sales.monthly_kpis, sales.seller_performance):
        assert plan(build(tables)).count("FileScan") == 4


def test_order_summaries_do_not_read_customers(tables):
    for build in (reports.delivery_status_summary, reports.delay_bucket_summary):
        assert plan(build(tables)).count("FileScan") == 2


def test_retention_reads_each_table_once(tables):
    assert plan(cohort.cohort_retention_matrix(tables)).count("FileScan") == 2


def test_order_level_joins_share_one_shuffle(tables, conf):
    """Customers, then orders, items and reviews by order: five row-level shuffles."""
    conf(**NO_BROADCAST)
    text = plan(sales.monthly_kpis(tables))
    assert text.count("Exchange hashpartitioning(customer_id") == 2
    assert text.count("Exchange hashpartitioning(order_id") == 3


def test_top_reports_do_not_sort_everything(tables):
    for build in (reports.seller_top_revenue, reports.customer_orders_first):
        text = plan(build(tables))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_first_deliveries_read_each_table_once_and_shuffle_none(tables, conf):
    """Also with joins that can't broadcast: what they shuffle has passed the reduced scans."""
    conf(**NO_BROADCAST)
    df = reports.delivery_performance_first(tables)
    df.collect()
    ran = without_initial_plans(plan(df))
    # A subquery's other uses, also as a filter of the scan, show only its number.
    scans = re.findall(r"FileScan parquet .*?Location: InMemoryFileIndex\(1 paths\)\[\S*/(\w+)\]", ran)
    assert sorted(scans) == ["customers", "orders", "reviews"]


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
@pytest.mark.parametrize("name", all_queries())
def test_status_filter_reaches_the_scan_of_the_source(spark, name):
    """The source holds a code and the state is derived; filters must test the code itself."""
    text = plan(all_queries()[name](spark, DATA))
    filters = [line for line in text.splitlines() if "Filter " in line and "orderstatus" in line]
    assert not any("delivered" in line for line in filters)
    pushed = text.count("EqualNullSafe(o_orderstatus,F)")
    assert pushed == sum("(o_orderstatus" in line and "<=> F)" in line for line in filters)


def test_status_filters_exist_to_be_pushed(spark):
    found = [
        name for name in ON_STAGING
        if "EqualNullSafe(o_orderstatus,F)" in plan(all_queries()[name](spark, DATA))
    ]
    assert {"monthly_kpis", "delivery_performance", "customer_orders", "seller_performance"} <= set(found)
    assert len(found) >= 20


def test_cleaning_shares_one_grouping_of_whole_rows(spark, tmp_path):
    """Counting copies shuffles once; profile, duplicates and cleaning then shuffle no rows."""
    raw = files.read_raw_all(spark, micro.write_raw(tmp_path / "csv"))
    translation = raw.pop("category_translation")
    for name, table in raw.items():
        counted = cleaning.count_copies(table)
        assert plan(counted).count("Exchange hashpartitioning") == 1
        counted.write.parquet(str(tmp_path / name))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in raw}
    for table in tables.values():
        assert "hashpartitioning" not in plan(profile.profile_counted(table))
        assert "hashpartitioning" not in plan(profile.duplicates_counted(table))
    cleaned = cleaning.clean_all(
        {**tables, "category_translation": translation}, cleaning.without_copies
    )
    for name, table in cleaned.items():
        assert "hashpartitioning" not in plan(table), name


def test_review_dedup_limits_before_the_shuffle(tables):
    from mercato.operators.quality import dedup_reviews

    text = plan(dedup_reviews(tables["reviews"]))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "build, joins",
    [
        # Orders to a hot customer, items to a hot product, items to a hot order.
        (sales.sales_order_items, 3),
        (sales.category_performance, 3),
        (sales.seller_performance, 2),
        (delivery.delivery_review_impact, 2),
        (cohort.customer_orders, 1),
        # Also reviews of a hot order, orders of a hot person.
        (delivery.delivery_performance, 2),
        (cohort.customer_cohorts, 2),
    ],
)
def test_skewed_joins_are_split(tables, conf, build, joins):
    conf(
        **NO_BROADCAST,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    df = build(tables)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("SortMergeJoin(skew=true)") >= joins


def test_partitioned_write_is_rebalanced(tables, tmp_path, spark):
    files.write_table(tables["orders"], str(tmp_path / "o"), "purchase_month")
    back = spark.read.parquet(str(tmp_path / "o"))
    assert dict(back.dtypes)["purchase_month"] == "string"
    assert back.count() == tables["orders"].count()
    assert back.filter("purchase_month is null").count() == tables["orders"].filter(
        "purchase_month is null"
    ).count()
    # One file per month: small partitions are not scattered over all tasks.
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in (tmp_path / "o").glob("purchase_*"))
