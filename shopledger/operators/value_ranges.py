"""Ordering rows of any number by value without gathering them in one task.

Values are cut into fixed ranges, 256 for every doubling unless told otherwise. The cut depends on
nothing but the value: no sample, no first pass, the same in every branch of a
plan. Rows are ordered inside each range by its own task; only one number per
range, of which there are some ten thousand at most, meets in one place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PER_DOUBLING = 256


def range_of(value: Column, per_doubling: int = _PER_DOUBLING) -> Column:
    """Number of the value's range, never falling as the value rises; null for null."""
    number = value.cast("double")
    size = F.floor(F.log2(F.abs(number) + 1) * per_doubling).cast("int")
    return F.when(number < 0, -size).otherwise(size)
