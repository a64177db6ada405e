"""Running totals over whole tables without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sharing import zero_of_all
from .value_ranges import range_of


def running_total(
    df: DataFrame, value: str, ties: Sequence[Column], out: str, grand_total: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to this one, largest value first.

    ``ties`` orders rows of equal value and must make the order total;
    ``grand_total`` names a further column for the sum over all rows. Each
    range of values is summed by its own task and shifted by the sum of the
    ranges before it; only those sums meet in one task. Nothing is written.
    """
    ranged = df.withColumn("_range", -range_of(F.col(value)))
    in_order = Window.orderBy("_range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        ranged.groupBy(F.col("_range").alias("_of_range"))
        .agg((F.sum(value) + F.sum(zero_of_all(df))).alias("_sum"))
        .withColumnRenamed("_of_range", "_range")
        .select(
            F.col("_range").alias("_of_range"),
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_sum").over(everything).alias(grand_total),
        )
    )
    inside = (
        Window.partitionBy("_range").orderBy(F.col(value).desc(), *ties)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        ranged.withColumn("_local", F.sum(value).over(inside))
        .join(offsets, F.col("_range").eqNullSafe(F.col("_of_range")))
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop("_range", "_of_range", "_local", "_offset")
    )
