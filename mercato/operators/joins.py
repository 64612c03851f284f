"""Joins written so that adaptive execution can split a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join_split(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` left-outer-join ``right`` on ``key``, where either side may have a hot key.

    Spark doesn't split the optional side of an outer join. It splits both sides of an
    inner join, and for rows without a match the right keys are combined per task, so a
    hot one arrives as a few rows. ``left`` is read twice.
    """
    alone = left.join(right.select(key).distinct(), key, "left_anti")
    return left.join(right, key).unionByName(alone, allowMissingColumns=True)
