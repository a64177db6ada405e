"""Landed CSV files: read as text, tagged with where each row came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import known
from ..operators.cleaning import LANDING_ORDER
from ..schemas import ENTITIES

CSV_OPTIONS = {"header": "true", "escape": '"', "encoding": "UTF-8", "enforceSchema": "false"}


def position(path: str = "_metadata.file_path", block: str = "_metadata.file_block_start") -> Column:
    """Place of a row in the landed files, total and stable across retries.

    A task reads one block of a file from front to back, so the running id
    orders rows inside a block and path and block start order the blocks.
    """
    return F.struct(
        F.col(path).alias("path"), F.col(block).alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_landing(
    spark: SparkSession, directory: str, name: str, multiline: bool = False,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``<directory>/<name>.csv`` (a file or a folder of files), or of some ``files`` of it.

    Columns are matched by header name. A missing file or column fails here.
    ``multiline`` accepts line breaks inside quotes, at the price of one task
    per file.
    """
    rows = (
        spark.read.options(**CSV_OPTIONS).option("multiLine", multiline)
        .csv(f"{directory}/{name}.csv" if files is None else list(files))
    )
    return rows.select(
        *(known(c).alias(c) for c in ENTITIES[name].staged.names),
        F.col("_metadata.file_name").alias("source_file"),
        position().alias(LANDING_ORDER),
    )


def append_raw(rows: DataFrame, path: str, load_id: str) -> None:
    """Add landed rows, as text, to a raw table together with the load and its time.

    The load's folder is replaced if it exists, so a load that is tried again adds nothing twice.
    """
    kept = rows.drop(LANDING_ORDER)
    text = kept.select(*(F.col(c).cast("string").alias(c) for c in kept.columns))
    text.withColumns({
        "load_dttm": F.current_timestamp(), "load_day": F.lit(load_id[:10]), "load_id": F.lit(load_id),
    }).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "load_day", "load_id").parquet(path)
