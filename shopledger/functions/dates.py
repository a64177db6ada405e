"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col


def month_of(date: Column | str) -> Column:
    """Month key ``YYYY-MM``; sorts as text the way it sorts in time."""
    return F.date_format(col(date), "yyyy-MM")


def weekday_from_sunday(date: Column | str) -> Column:
    """0 for Sunday up to 6 for Saturday (Spark itself counts 1 to 7)."""
    return F.dayofweek(col(date)) - 1


def is_weekend(date: Column | str) -> Column:
    return F.dayofweek(col(date)).isin(1, 7).cast("int")
