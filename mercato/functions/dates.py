"""Date arithmetic. Two notions of "days" live side by side on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def day_boundaries(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``; negative when ``end`` is earlier."""
    return F.datediff(end.cast("date"), start.cast("date"))


def floor_days(start: Column, end: Column) -> Column:
    """Elapsed 24-hour periods, rounded down also for negative durations."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    whole = micros - F.pmod(micros, F.lit(DAY_MICROS))
    return (whole / F.lit(DAY_MICROS)).cast("int")


def month_label(ts: Column) -> Column:
    """``yyyy-MM`` text; NULL for a missing timestamp."""
    return F.date_format(ts, "yyyy-MM")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "MM")


def month_gap(earlier: Column, later: Column) -> Column:
    """Calendar months from ``earlier`` to ``later``, ignoring the day of month."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
