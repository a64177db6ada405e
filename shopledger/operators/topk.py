"""Best or worst rows of every period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each ``by`` group, with their ``position``.

    Spark applies the limit in every map task before the shuffle, so a group
    of any size sends at most ``k`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("position", rank).filter(F.col("position") <= k)


def as_lists(
    ranked: DataFrame, by: str, fields: Sequence[str], lists: Mapping[str, Column]
) -> DataFrame:
    """Fold a ``top_k`` result into arrays of structs, one row per period.

    ``lists`` names each array and the condition its rows meet.
    """
    def entries(condition: Column) -> Column:
        row = F.when(condition, F.struct("position", *fields))
        ordered = F.sort_array(F.collect_list(row))
        return F.transform(ordered, lambda e: F.struct(*(e[f].alias(f) for f in fields)))

    return ranked.groupBy(by).agg(*(entries(c).alias(n) for n, c in lists.items()))
