import pytest

from mercato import catalog, pipeline
from mercato.operators import quality
from mercato.plans import cohort, delivery, reports, sales
from mercato.schemas import STAGING_TABLES
from mercato.sources import files
from tests import micro
from tests.conftest import rows


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("run")
    raw = micro.write_raw(home / "raw")
    return pipeline.run(spark, raw, str(home / "out")), home / "out"


def test_every_page_is_written(spark, run):
    tables, out = run
    for page, marts in pipeline.PAGES.items():
        for name in marts:
            assert spark.read.parquet(str(out / "marts" / page / name)).columns


@pytest.mark.parametrize(
    "page, name, build",
    [
        ("executive", "monthly_kpis", reports.monthly_kpis),
        ("executive", "category_performance", sales.category_performance),
        ("delivery", "delivery_performance", delivery.delivery_performance),
        ("delivery", "state_delivery_kpis", reports.state_delivery_kpis),
        ("review_impact", "delivery_status_summary", reports.delivery_status_summary),
        ("review_impact", "delay_bucket_summary", reports.delay_bucket_summary),
        ("cohort", "customer_cohorts", cohort.customer_cohorts),
        ("cohort", "cohort_retention_matrix", cohort.cohort_retention_matrix),
        ("cohort", "order_count_histogram", reports.order_count_histogram),
        ("seller", "seller_risk_segments", sales.seller_risk_segments),
        ("seller", "seller_segment_summary", reports.seller_segment_summary),
    ],
)
def test_marts_from_shared_results_equal_direct_ones(spark, run, page, name, build):
    tables, out = run
    assert rows(spark.read.parquet(str(out / "marts" / page / name))) == rows(build(tables))


def test_quality_reports_are_written(spark, run):
    _, out = run
    duplicates = spark.read.parquet(str(out / "quality" / "review_duplicates"))
    assert rows(duplicates) == [("r4", 2)]
    counted = rows(spark.read.parquet(str(out / "quality" / "duplicate_rows")))
    assert ("customers", 7, 6, 1) in counted
    columns_per_table = (8, 6, 5, 4, 3, 4)
    profiled = spark.read.parquet(str(out / "quality" / "profile"))
    assert profiled.count() == sum(columns_per_table)


def test_one_page_writes_only_what_it_needs(spark, run, tmp_path, monkeypatch):
    tables, _ = run
    written, write = [], files.write_table
    monkeypatch.setattr(pipeline, "shared_dir", lambda spark, out_dir: f"{out_dir}/_shared")
    monkeypatch.setattr(files, "write_table", lambda df, path: (written.append(path), write(df, path)))
    pipeline.write_marts(spark, tables, str(tmp_path), ["cohort"])
    assert [p.name for p in tmp_path.iterdir()] == ["cohort"]
    assert sorted(p for p in written if "_shared" in p) == [
        f"{tmp_path}/_shared/cohort_counts", f"{tmp_path}/_shared/customer_orders",
    ]


class _Broken(Exception):
    pass


def _fail(*_):
    raise _Broken


def _marts(spark, out):
    """The rows of every dataset under ``out`` and the names beside the pages."""
    found = {
        f"{page}/{name}": rows(spark.read.parquet(str(out / page / name)))
        for page, marts in pipeline.PAGES.items()
        for name in marts
        if (out / page / name).exists()
    }
    return found, sorted(p.name for p in out.iterdir())


def test_a_failed_mart_leaves_all_old_ones(spark, run, tmp_path, monkeypatch):
    tables, _ = run
    pipeline.write_marts(spark, tables, str(tmp_path))
    before = _marts(spark, tmp_path)
    fewer = {**tables, "orders": tables["orders"].filter("order_id <> 'o1'")}
    with monkeypatch.context() as broken:
        broken.setitem(pipeline.PAGES["seller"], "seller_segment_summary", _fail)
        with pytest.raises(_Broken):
            pipeline.write_marts(spark, fewer, str(tmp_path))
    assert _marts(spark, tmp_path) == before
    pipeline.write_marts(spark, fewer, str(tmp_path))
    after, names = _marts(spark, tmp_path)
    assert names == before[1] and after.keys() == before[0].keys()
    assert after["executive/monthly_kpis"] != before[0]["executive/monthly_kpis"]


def test_a_failed_move_brings_the_old_marts_back(spark, run, tmp_path, monkeypatch):
    tables, _ = run
    pipeline.write_marts(spark, tables, str(tmp_path), ["cohort", "seller"])
    before = _marts(spark, tmp_path)
    fewer = {**tables, "orders": tables["orders"].filter("order_id <> 'o1'")}
    move = pipeline._move

    def moves_but_one(spark, source, target):
        if "_draft" in source and source.endswith("seller_risk_segments"):
            raise _Broken
        move(spark, source, target)

    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "_move", moves_but_one)
        with pytest.raises(_Broken):
            pipeline.write_marts(spark, fewer, str(tmp_path), ["cohort", "seller", "executive"])
    assert _marts(spark, tmp_path) == before


@pytest.mark.parametrize("beside", ["cp", "out-cp", "out/cp"])
def test_working_folders_go_also_after_a_failure(spark, run, tmp_path, monkeypatch, beside):
    tables, _ = run
    out, checkpoints = tmp_path / "out", tmp_path / beside
    monkeypatch.setattr(
        pipeline, "shared_dir", lambda spark, out_dir: f"{checkpoints}/mercato-1"
    )
    with monkeypatch.context() as broken:
        broken.setitem(pipeline.PAGES["seller"], "seller_segment_summary", _fail)
        with pytest.raises(_Broken):
            pipeline.write_marts(spark, tables, str(out), ["seller"])
    assert not (checkpoints / "mercato-1").exists()
    pipeline.write_marts(spark, tables, str(out), ["seller"])
    assert not (checkpoints / "mercato-1").exists()
    assert sorted(p.name for p in (out / "seller").iterdir()) == sorted(pipeline.PAGES["seller"])


class _Session:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default):
        return self.settings.get(key, default)


def test_shared_results_go_to_the_checkpoint_folder():
    named = _Session(**{"spark.checkpoint.dir": "hdfs://x/checkpoints/"})
    assert pipeline.shared_dir(named, "out").startswith("hdfs://x/checkpoints/mercato-")
    assert pipeline.shared_dir(_Session(), "out").startswith("out/_shared-")


def test_broken_key_stops_the_run(spark, run, tmp_path):
    tables, _ = run
    twice = {**tables, "products": tables["products"].union(tables["products"])}
    with pytest.raises(pipeline.KeyViolation, match=r"products\(product_id\): 3 repeated"):
        pipeline.require_keys(quality.key_audits(twice))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_staging_round_trip(spark, run, tmp_path, fmt):
    tables, _ = run
    files.write_staging(tables, str(tmp_path), fmt)
    back = files.read_staging(spark, str(tmp_path), fmt)
    assert set(back) == set(STAGING_TABLES)
    for name in STAGING_TABLES:
        columns = tables[name].columns
        assert rows(back[name], *columns) == rows(tables[name], *columns), name
        # An extra column read from CSV stays text.
        assert dict(back[name].dtypes) == dict(tables[name].dtypes)


def test_cleaned_csv_with_float_days(spark, run, tmp_path):
    """Cleaned files written elsewhere store nullable whole numbers as ``7.0``."""
    tables, _ = run
    files.write_staging(tables, str(tmp_path), "csv")
    orders = tables["orders"]
    floats = orders.withColumn("delivery_days", orders.delivery_days.cast("double"))
    files.write_table(floats, files.staging_path(str(tmp_path), "orders", "csv"), fmt="csv")
    back = files.read_staging(spark, str(tmp_path), "csv")
    assert rows(back["orders"], "order_id", "delivery_days")[0] == ("o1", 7)


def test_views(spark, run):
    tables, _ = run
    catalog.register_views(spark, tables)
    got = spark.sql("SELECT count(*) AS n FROM vw_sales_order_items").first().n
    assert got == 9
    assert spark.sql("SELECT count(*) AS n FROM staging_orders").first().n == 6
    for name in catalog.VIEWS:
        assert spark.table(name).columns


def test_saved_namespaces(spark, run):
    tables, _ = run
    saved = catalog.save_staging(spark, tables)
    catalog.save_marts(spark, saved)
    assert spark.sql("SELECT total_orders FROM analytics.vw_monthly_kpis").count() == 3
    assert spark.table("staging.orders").count() == 6
    names = {t.name for t in spark.catalog.listTables("analytics") if not t.isTemporary}
    assert names == set(catalog.VIEWS)
    for database in ("analytics", "staging"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
