"""Letting several consumers of one intermediate result share its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_of_all(df: DataFrame) -> Column:
    """Zero, computed from every column.

    Spark computes a shuffle once for all consumers that ask for the same
    columns of it, but cuts unread columns from each one by itself. A consumer
    that reads few columns adds this zero to what it counts or sums, and so
    asks for the same as the consumer that reads them all.
    """
    return F.xxhash64(*df.columns).bitwiseAND(F.lit(0).cast("bigint"))
