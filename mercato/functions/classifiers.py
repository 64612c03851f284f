"""Labels and flags used by the marts, each a plain column expression."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delay buckets as (first day, last day, label, sort key), inclusive.
DELAY_BUCKETS = (
    (None, -7, "Early by 7+ days", 1),
    (-6, -1, "Early by 1-6 days", 2),
    (0, 0, "Delivered on estimated date", 3),
    (1, 3, "Late by 1-3 days", 4),
    (4, 7, "Late by 4-7 days", 5),
    (8, None, "Late by 8+ days", 6),
)
UNKNOWN_BUCKET = ("Unknown", 99)

# A review is low up to, and high from, these scores.
LOW_SCORE = 2
HIGH_SCORE = 4

# Order in which risk segments are listed.
RISK_ORDER = {"High Risk": 1, "Medium Risk": 2}
RISK_ORDER_OTHER = 3


@dataclass(frozen=True)
class SellerThresholds:
    """Limits of the seller segments."""

    established_orders: int = 50
    low_volume_orders: int = 10
    high_revenue: Decimal = Decimal("10000")
    weak_review: Decimal = Decimal("4.0")
    strong_review: Decimal = Decimal("4.5")
    risky_late_pct: Decimal = Decimal("15")
    reliable_late_pct: Decimal = Decimal("10")
    risky_low_review_pct: Decimal = Decimal("20")


@dataclass(frozen=True)
class StateThresholds:
    """Limits of the state risk segments and the smallest state reported."""

    min_orders: int = 100
    high_late_pct: Decimal = Decimal("15")
    medium_late_pct: Decimal = Decimal("10")
    weak_review: Decimal = Decimal("4.0")


def delivery_status(is_late: Column) -> Column:
    return (
        F.when(is_late == 1, "Late").when(is_late == 0, "On Time or Early").otherwise("Unknown")
    )


def _delay_case(delay_days: Column, position: int) -> Column:
    case = F
    for first, last, *outcome in DELAY_BUCKETS:
        inside = F.lit(True)
        if first is not None:
            inside = inside & (delay_days >= first)
        if last is not None:
            inside = inside & (delay_days <= last)
        case = case.when(inside, outcome[position])
    return case.otherwise(UNKNOWN_BUCKET[position])


def delay_bucket(delay_days: Column) -> Column:
    return _delay_case(delay_days, 0)


def delay_bucket_sort(delay_days: Column) -> Column:
    return _delay_case(delay_days, 1)


def is_low(score: Column) -> Column:
    return score <= LOW_SCORE


def is_high(score: Column) -> Column:
    return score >= HIGH_SCORE


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def seller_segment(
    orders: Column,
    revenue: Column,
    avg_review: Column,
    late_pct: Column,
    low_review_pct: Column,
    limits: SellerThresholds = SellerThresholds(),
) -> Column:
    """Segment of a seller; the rates are the published, rounded ones."""
    established = orders >= limits.established_orders
    weak_service = (
        (avg_review < limits.weak_review)
        | (late_pct >= limits.risky_late_pct)
        | (low_review_pct >= limits.risky_low_review_pct)
    )
    strong_service = (avg_review >= limits.strong_review) & (late_pct < limits.reliable_late_pct)
    return (
        F.when(
            established & (revenue >= limits.high_revenue) & weak_service,
            "High Revenue / High Risk",
        )
        .when(established & strong_service, "Reliable Seller")
        .when(orders < limits.low_volume_orders, "Low Volume Seller")
        .otherwise("Standard Seller")
    )


def logistics_risk(
    late_pct: Column, avg_review: Column, limits: StateThresholds = StateThresholds()
) -> Column:
    """Segment of a state; ``late_pct`` is the unrounded rate."""
    weak_review = avg_review < limits.weak_review
    return (
        F.when((late_pct >= limits.high_late_pct) & weak_review, "High Risk")
        .when((late_pct >= limits.medium_late_pct) | weak_review, "Medium Risk")
        .otherwise("Low Risk")
    )


def risk_rank(segment: Column) -> Column:
    case = F
    for name, rank in RISK_ORDER.items():
        case = case.when(segment == name, rank)
    return case.otherwise(RISK_ORDER_OTHER)
