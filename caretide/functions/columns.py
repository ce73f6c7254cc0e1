"""Shared helpers for column arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 if true, 0 if false or null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def finite(c: Column | str) -> Column:
    """Number as DOUBLE with NaN turned into NULL."""
    value = as_col(c).cast("double")
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)
