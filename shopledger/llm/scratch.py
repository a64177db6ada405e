"""Intermediate tables in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Give the executors this package, as `--py-files` would, for sessions that were started without it."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).parent
    path = Path(tempfile.mkdtemp()) / "training_text.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in [package.parent / "__init__.py", *sorted(package.glob("*.py"))]:
            archive.write(file, file.relative_to(package.parent.parent))
    context.addPyFile(str(path))
    _sent.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below `spark.checkpoint.dir`; where that is unset (tests), below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet and read again: cuts the lineage, and lost executors cost nothing.

    The tables stay until the folder of `shared_folder` is cleared, because results read them lazily.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
