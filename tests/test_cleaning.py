import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mercato.operators import cleaning, profile
from mercato.schemas import NULL_TOKENS, ORDER_TIMESTAMPS, RAW_TABLES
from mercato.sources import files
from tests import micro
from tests.conftest import rows


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return files.read_raw_all(spark, micro.write_raw(tmp_path_factory.mktemp("raw")))


@pytest.fixture(scope="module")
def cleaned(raw):
    return cleaning.clean_all(raw)


def test_raw_types_and_extra_columns(raw):
    assert set(raw) == set(RAW_TABLES)
    types = dict(raw["order_items"].dtypes)
    assert types["price"] == "decimal(10,2)" and types["order_item_id"] == "int"
    assert dict(raw["products"].dtypes)["product_name_lenght"] == "int"
    assert dict(raw["products"].dtypes)["shelf"] == "string"
    assert dict(raw["orders"].dtypes)["order_purchase_timestamp"] == "string"


def test_whole_numbers_written_as_decimals(raw):
    got = rows(raw["products"], "product_id", "product_name_lenght", "product_description_lenght")
    assert got == [("p1", 12, 100), ("p2", 7, 50), ("p3", None, 20)]


def test_quoted_text_with_line_break(raw):
    got = dict(rows(raw["reviews"], "review_id", "review_comment_message")[:2])
    assert got["r1"] == 'good, "really"\nand fast'
    assert got["r2"] is None


def test_null_tokens(spark):
    df = spark.createDataFrame([(t, 1) for t in [*NULL_TOKENS, "nan ", "x"]], "a string, b int")
    kept = files.nullify_tokens(df).filter("a is not null")
    assert rows(kept, "a") == [("nan ",), ("x",)]


def test_bad_number_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("order_id,price\no1,12x\n")
    df = files.read_csv(spark, str(path), {"order_id": "string", "price": "decimal(10,2)"})
    with pytest.raises(PySparkException):
        df.collect()


def test_bad_timestamp_fails(raw):
    broken = raw["orders"].withColumn("order_approved_at", F.lit("not a time"))
    with pytest.raises(PySparkException):
        cleaning.clean_orders(broken).collect()


def test_order_kpis(cleaned):
    got = rows(cleaned["orders"], "order_id", "delivery_days", "is_late", "purchase_month")
    assert got == [
        ("o1", 7, 1, "2018-01"),
        ("o2", 4, 0, "2018-03"),
        ("o3", 10, 1, "2018-01"),
        ("o4", None, 0, "2018-02"),
        ("o5", None, 0, "2018-02"),
        ("o6", -1, 0, "2018-02"),
    ]
    assert cleaned["orders"].columns[-3:] == ["delivery_days", "is_late", "purchase_month"]


def test_missing_purchase_time_has_no_month(spark):
    row = ("o", *[None] * 5)
    names = "order_id string, " + ", ".join(f"{n} string" for n in ORDER_TIMESTAMPS)
    got = cleaning.with_delivery_kpis(
        cleaning.parse_order_timestamps(spark.createDataFrame([row], names))
    )
    assert rows(got, "delivery_days", "is_late", "purchase_month") == [(None, 0, None)]


def test_items_keep_valid_amounts(cleaned):
    got = rows(cleaned["order_items"], "order_id", "order_item_id", "price", "freight_value")
    assert len(got) == 7
    assert [r for r in got if r[0] == "o2"] == [("o2", 1, D("100.00"), D("10.00"))]
    assert ("o3", 1, D("20.00"), D("0.00")) in got


def test_products_filled_translated_renamed(cleaned):
    assert cleaned["products"].columns == [
        "product_id",
        "product_category_name",
        "product_name_length",
        "product_description_length",
        "shelf",
        "product_category_name_english",
    ]
    got = rows(
        cleaned["products"], "product_id", "product_category_name", "product_category_name_english"
    )
    assert got == [
        ("p1", "beleza_saude", "health_beauty"),
        ("p2", "unknown", None),
        ("p3", "brinquedos", None),
    ]


def test_repeated_translation_repeats_products(raw):
    twice = raw["category_translation"].union(raw["category_translation"])
    assert cleaning.clean_products(raw["products"], twice).count() == 4


def test_full_row_dedup(raw, cleaned):
    assert raw["customers"].count() == 7 and cleaned["customers"].count() == 6
    assert cleaned["reviews"].count() == 5


def test_dedup_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, None), (2, None)], "a int, b int")
    assert cleaning.drop_duplicate_rows(df).count() == 2


def test_profile(raw):
    got = rows(profile.profile(raw["order_items"]))
    assert (5, "price", "decimal(10,2)", 10, 2) in got
    assert [r[1] for r in got] == raw["order_items"].columns


def test_duplicate_rows(raw):
    assert rows(profile.duplicate_rows(raw["customers"])) == [(7, 6, 1)]
    empty = raw["customers"].limit(0)
    assert rows(profile.duplicate_rows(empty)) == [(0, 0, 0)]


def test_purchase_times(cleaned):
    times = dict(rows(cleaned["orders"], "order_id", "order_purchase_timestamp"))
    assert times["o1"] == dt.datetime(2018, 1, 31, 23)
