"""Exact decimal rates, means and money.

Money is summed as integer cents: a long sum is a plain in-place buffer in the hash
aggregate, exact, and under ANSI it fails loudly instead of overflowing.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(part: Column, whole: Column, precision: int = 10) -> Column:
    """``100 * part / whole`` rounded half-up to two decimals; NULL when ``whole`` is 0."""
    return exact_pct(part, whole).cast(f"decimal({precision},2)")


def exact_pct(part: Column, whole: Column) -> Column:
    """The rate before rounding, for rules that test it unrounded."""
    return F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0))


def mean(total: Column, count: Column) -> Column:
    """``total / count`` with six decimals, half-up; NULL when there is nothing to average."""
    return (total.cast("decimal(24,6)") / F.nullif(count, F.lit(0))).cast("decimal(14,6)")


def cents(amount: Column) -> Column:
    return (amount.cast("decimal(10,2)") * 100).cast("long")


def money(total_cents: Column) -> Column:
    return (total_cents * F.lit(Decimal("0.01"))).cast("decimal(20,2)")
