"""The CSV reader changes nothing silently: it keeps a value or fails."""

import pytest

from mercato.sources import files

TYPES = {"order_id": "string", "review_score": "int", "price": "decimal(10,2)"}

FAILS = "MALFORMED|USER_RAISED|CAST_INVALID|CSV header|column names"


def read(spark, tmp_path, *texts):
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_text(text)
    return files.read_csv(spark, str(tmp_path), TYPES)


def test_values_are_kept(spark, tmp_path):
    df = read(spark, tmp_path, "order_id,review_score,price\no1,4.0,12.30\no2,,0.5\n")
    assert [(r[0], r[1], str(r[2])) for r in df.orderBy("order_id").collect()] == [
        ("o1", 4, "12.30"), ("o2", None, "0.50"),
    ]


@pytest.mark.parametrize(
    "row",
    ["o1,3.7,1.00", "o1,3,0.004", "o1,3,12.345", "o1,3,1.00,more", "o1,3", "o1,x,1.00"],
    ids=["fraction", "tiny amount", "three decimals", "extra field", "short row", "text"],
)
def test_bad_rows_fail_even_for_other_columns(spark, tmp_path, row):
    df = read(spark, tmp_path, f"order_id,review_score,price\n{row}\n")
    with pytest.raises(Exception, match=FAILS):
        df.collect()


def test_extra_field_fails_a_narrow_query(spark, tmp_path):
    df = read(spark, tmp_path, "order_id,review_score,price\no1,3,1.00,more\n")
    with pytest.raises(Exception, match=FAILS):
        df.select("order_id").collect()


def test_other_column_order_fails(spark, tmp_path):
    df = read(
        spark, tmp_path,
        "order_id,review_score,price\no1,3,1.00\n", "order_id,price,review_score\no2,1.00,3\n",
    )
    with pytest.raises(Exception, match=FAILS):
        df.collect()


def test_two_distributions_fail(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}_orders_dataset.csv").write_text("order_id\no1\n")
    with pytest.raises(ValueError, match="matches 2 files"):
        files.read_raw(spark, str(tmp_path), "orders")
