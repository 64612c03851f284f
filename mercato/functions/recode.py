"""Codes to names in a form that predicates on the name can be traced back through."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def recoded(code: Column, names: dict[str, str]) -> Column:
    """The name of each code; NULL for a NULL code and for one without a name.

    One test within the other, each null-safe: a comparison with the first name then folds
    into one test of the code itself, which reaches the scan as a pushed filter. So put the
    name that is asked for most first. A CASE of several branches stays whole above the scan.
    """
    out = F.lit(None).cast("string")
    for value, name in reversed(names.items()):
        out = F.when(code.eqNullSafe(value), name).otherwise(out)
    return out
