"""Derived tables on Parquet folders by month, some of whose months can be replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIVE = "live"


def replace_months(
    rows: DataFrame, path: str, column: str, months: tuple[str, ...] | None
) -> None:
    """Rewrite the folders of some months, or everything where ``months`` is None.

    ``rows`` hold these months only. Spark replaces the folders it writes to, so
    each given month gets a row that isn't ``live``: a month that has lost all
    its rows is then replaced too.
    """
    rows = rows.withColumn(LIVE, F.lit(True))
    if months is not None:
        given = rows.sparkSession.createDataFrame(
            [(m, False) for m in months], f"{column} string, {LIVE} boolean")
        rows = rows.unionByName(given, allowMissingColumns=True)
    (
        rows.hint("rebalance", column).write.partitionBy(column).mode("overwrite")
        .option("partitionOverwriteMode", "static" if months is None else "dynamic").parquet(path)
    )


def read_months(spark: SparkSession, path: str, layout: T.StructType | str) -> DataFrame:
    """The live rows; the layout is given, as a month in a folder's name could pass for a date."""
    layout = T.StructType.fromDDL(layout) if isinstance(layout, str) else layout
    whole = T.StructType([*layout.fields, T.StructField(LIVE, T.BooleanType())])
    return spark.read.schema(whole).parquet(path).filter(LIVE).drop(LIVE)
