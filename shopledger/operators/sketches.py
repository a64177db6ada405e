"""Distinct counts as mergeable sketches: small binaries stored next to sums and added up like them.

A sketch of ``lg_k`` holds 2**lg_k registers, one byte each, and far less while
it has seen few values. Its estimate has a standard error of at most
``standard_error(lg_k)`` of the count, whatever was merged into it; up to a tenth of
2**lg_k values are counted one by one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LG_K = 15


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketch(c: Column | str, lg_k: int = LG_K) -> Column:
    """Aggregate: the values of a column; nulls don't count."""
    return F.hll_sketch_agg(c, F.lit(lg_k))


def merged(c: Column | str) -> Column:
    """Aggregate: one sketch of all values that several sketches have seen."""
    return F.hll_union_agg(c)


def estimate(c: Column | str) -> Column:
    """The number of distinct values; no sketch has seen none."""
    return F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("bigint"))
