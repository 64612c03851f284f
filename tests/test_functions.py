"""Column functions at both sides of every limit."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from mercato.functions import classifiers, dates, rates


def values(spark, schema, data, expression):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], f"_i int, {schema}")
    return [row[0] for row in df.orderBy("_i").select(expression).collect()]


def test_delay_bucket_limits(spark):
    days = [-8, -7, -6, -1, 0, 1, 3, 4, 7, 8, None]
    data = [(day,) for day in days]
    sort = values(spark, "d int", data, classifiers.delay_bucket_sort(F.col("d")))
    assert sort == [1, 1, 2, 2, 3, 4, 4, 5, 5, 6, 99]
    names = values(spark, "d int", data, classifiers.delay_bucket(F.col("d")))
    assert len(set(zip(names, sort))) == 7 == len(set(names))
    assert (names[0], names[4], names[9], names[10]) == (
        "Early by 7+ days",
        "Delivered on estimated date",
        "Late by 8+ days",
        "Unknown",
    )


def test_delivery_status(spark):
    got = values(spark, "l int", [(1,), (0,), (None,)], classifiers.delivery_status(F.col("l")))
    assert got == ["Late", "On Time or Early", "Unknown"]


def test_score_flags(spark):
    data = [(score,) for score in (None, 1, 2, 3, 4, 5)]
    score = F.col("s")
    low = values(spark, "s int", data, classifiers.flag(classifiers.is_low(score)))
    high = values(spark, "s int", data, classifiers.flag(classifiers.is_high(score)))
    assert low == [0, 1, 1, 0, 0, 0]
    assert high == [0, 0, 0, 0, 1, 1]


RISK, RELIABLE = "High Revenue / High Risk", "Reliable Seller"
LOW, STANDARD = "Low Volume Seller", "Standard Seller"


@pytest.mark.parametrize(
    "orders, revenue, review, late, low, segment",
    [
        (50, "10000", "3.99", "0", "0", RISK),
        (49, "10000", "3.99", "0", "0", STANDARD),
        (50, "9999.99", "3.99", "0", "0", STANDARD),
        (50, "10000", "4.0", "0", "0", STANDARD),
        (50, "10000", "4.0", "14.99", "0", STANDARD),
        (50, "10000", "4.0", "15", "0", RISK),
        (50, "10000", "4.0", "0", "19.99", STANDARD),
        (50, "10000", "4.0", "0", "20", RISK),
        (50, "10000", None, "0", "0", STANDARD),
        (50, "10000", None, "15", "0", RISK),
        (50, "0", "4.5", "9.99", "0", RELIABLE),
        (50, "0", "4.49", "9.99", "0", STANDARD),
        (50, "0", "4.5", "10", "0", STANDARD),
        (49, "0", "4.5", "9.99", "0", STANDARD),
        (50, "10000", "4.5", "9.99", "20", RISK),
        (9, "99999", "1", "99", "99", LOW),
        (10, "0", "1", "99", "99", STANDARD),
    ],
)
def test_seller_segment(spark, orders, revenue, review, late, low, segment):
    row = (orders, D(revenue), review and D(review), D(late), D(low))
    schema = "o long, r decimal(20,2), v decimal(14,6), l decimal(10,2), w decimal(10,2)"
    got = values(spark, schema, [row], classifiers.seller_segment(*map(F.col, "orvlw")))
    assert got == [segment]


@pytest.mark.parametrize(
    "late, review, segment",
    [
        ("15", "3.9", "High Risk"),
        ("14.996", "3.9", "Medium Risk"),
        ("15", "4.0", "Medium Risk"),
        ("10", "4.0", "Medium Risk"),
        ("9.999", "4.0", "Low Risk"),
        ("0", "3.999999", "Medium Risk"),
        ("9", None, "Low Risk"),
    ],
)
def test_logistics_risk(spark, late, review, segment):
    row = (D(late), review and D(review))
    got = values(
        spark,
        "l decimal(20,6), v decimal(14,6)",
        [row],
        classifiers.logistics_risk(F.col("l"), F.col("v")),
    )
    assert got == [segment]


def test_risk_rank(spark):
    data = [("High Risk",), ("Medium Risk",), ("Low Risk",)]
    assert values(spark, "s string", data, classifiers.risk_rank(F.col("s"))) == [1, 2, 3]


def test_pct_is_exact_and_half_up(spark):
    data = [(201, 20000), (1, 800), (1, 3), (2, 3), (0, 7), (5, 0), (7, 7)]
    got = values(spark, "a long, b long", data, rates.pct(F.col("a"), F.col("b")))
    assert [None if v is None else str(v) for v in got] == [
        "1.01", "0.13", "33.33", "66.67", "0.00", None, "100.00",
    ]


def test_mean_rounds_half_away_from_zero(spark):
    data = [(11, 3), (-1, 3), (-2, 3), (0, 0), (1, 2_000_000), (-1, 2_000_000)]
    got = values(spark, "a long, b long", data, rates.mean(F.col("a"), F.col("b")))
    assert [None if v is None else f"{v:f}" for v in got] == [
        "3.666667", "-0.333333", "-0.666667", None, "0.000001", "-0.000001",
    ]


def test_money_round_trip(spark):
    amounts = [D("0.01"), D("99999999.99"), D("-1.10")]
    got = values(
        spark, "p decimal(10,2)", [(a,) for a in amounts], rates.money(rates.cents(F.col("p")))
    )
    assert got == amounts


def test_two_kinds_of_days(spark):
    pairs = [
        ("2018-01-01 23:59:59", "2018-01-02 00:00:01", 1, 0),
        ("2018-01-01 00:00:00", "2018-01-01 23:59:59", 0, 0),
        ("2018-02-20 10:00:00", "2018-02-20 05:00:00", 0, -1),
        ("2018-02-20 10:00:00", "2018-02-18 10:00:00", -2, -2),
        ("2018-02-20 10:00:00", "2018-02-18 09:59:59", -2, -3),
        ("2018-01-31 23:00:00", "2018-02-08 22:59:59", 8, 7),
    ]
    data = [tuple(map(dt.datetime.fromisoformat, pair[:2])) for pair in pairs]
    schema = "a timestamp_ntz, b timestamp_ntz"
    a, b = F.col("a"), F.col("b")
    assert values(spark, schema, data, dates.day_boundaries(a, b)) == [p[2] for p in pairs]
    assert values(spark, schema, data, dates.floor_days(a, b)) == [p[3] for p in pairs]


def test_floor_days_far_apart(spark):
    start = dt.datetime(1900, 1, 1)
    data = [(start, start + dt.timedelta(days=80000, microseconds=d)) for d in (-1, 0, 1)]
    got = values(
        spark, "a timestamp_ntz, b timestamp_ntz", data, dates.floor_days(F.col("a"), F.col("b"))
    )
    assert got == [79999, 80000, 80000]


def test_months(spark):
    data = [(dt.datetime(2018, 1, 31, 23), dt.datetime(2019, 3, 1)), (None, None)]
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert values(spark, schema, data, dates.month_label(F.col("a"))) == ["2018-01", None]
    assert values(spark, schema, data, dates.month_start(F.col("a"))) == [dt.date(2018, 1, 1), None]
    assert values(spark, schema, data, dates.month_gap(F.col("a"), F.col("b"))) == [14, None]
