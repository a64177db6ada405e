"""Competition ranks inside periods."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sharing import zero_of_all
from .value_ranges import range_of

# the ranges of a period are counted and joined, so a period has hundreds of them, not thousands
_PER_DOUBLING = 16
_MEASURE = 2**33
_BEFORE_ALL = -(2**31)  # null comes first, as in a plain window


def with_ranks(df: DataFrame, by: str, ranks: Mapping[str, Column]) -> DataFrame:
    """Add a rank column per entry of ``ranks`` (name to a number, least first), ties sharing one.

    A rank is the place inside the value's range plus the rows of the ranges before
    it, so a group of any size is ranked by many tasks. Each measure orders the rows
    in one shuffle, which the few counts of ranges join as they lie. The rows of all
    ranges are counted at once, over the same shuffle that ``df`` comes from.
    """
    # never null, so that joins and windows agree on the clustering
    period = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))
    # one number says measure and range, so that all measures join the same counts
    range_in = {
        name: F.lit(number * _MEASURE).cast("bigint")
        + F.coalesce(range_of(value, _PER_DOUBLING), F.lit(_BEFORE_ALL))
        for number, (name, value) in enumerate(ranks.items())
    }
    ranges = F.array(*(
        F.struct(F.lit(number).alias("_measure"), of.alias("_of_range"))
        for number, of in enumerate(range_in.values())
    ))
    in_order = (
        Window.partitionBy("_of", "_measure").orderBy("_of_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        df.select(period.alias("_of"), zero_of_all(df).alias("_zero"), F.inline(ranges))
        .groupBy("_of", "_measure", "_of_range").agg(F.sum(F.col("_zero") + 1).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(in_order), F.lit(0)))
        .select(F.col("_of").alias("_period"), F.col("_of_range").alias("_range"), "_before")
    )
    ranked = df.withColumn("_period", period)
    inside = Window.partitionBy("_period", "_range").orderBy("_value")
    for name, value in ranks.items():
        ranked = (
            ranked.withColumns({"_range": range_in[name], "_value": value})
            .withColumn("_place", F.rank().over(inside))
            .join(before, ["_period", "_range"])
            .withColumn(name, (F.col("_place") + F.col("_before")).cast("int"))
            .drop("_range", "_value", "_place", "_before")
        )
    return ranked.select(*df.columns, *ranks)
