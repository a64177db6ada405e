"""Which landed files are in raw, and with which load they came.

A file is known by its path, length and time of change. A load writes its rows
below ``load_day=<day>/load_id=<id>`` and then adds its files to the ledger;
readers of raw see only loads that the ledger names, so a load that died
half-way is invisible and its files are new again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_ENTRIES = "table_name string, path string, length bigint, modified timestamp, load_id string"
_FILE = ("path", "length", "modified")


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/raw/ledger"

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(_ENTRIES).json(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _ENTRIES)

    def files(self, name: str, *paths: str, only_new: bool = True) -> list[Row]:
        """Landed files below the paths, without those a load has brought; contents aren't read.

        The list is of files, as the reader's own listing on the driver is.
        """
        listed = (
            self.spark.read.format("binaryFile").load(list(paths))
            .select("path", "length", F.col("modificationTime").alias("modified"))
        )
        if only_new:
            known = self.entries().filter(F.col("table_name") == name).select(*_FILE)
            listed = listed.join(known, list(_FILE), "left_anti")
        return listed.orderBy("path").collect()

    def new_load(self) -> str:
        """A name that begins with the day and sorts by time."""
        clock = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH-mm-ss-SSSSSS")
        return f"{self.spark.range(1).select(clock).first()[0]}-{uuid.uuid4().hex[:8]}"

    def commit(self, name: str, files: Sequence[Row], load_id: str) -> None:
        rows = [(name, *(file[c] for c in _FILE), load_id) for file in files]
        self.spark.createDataFrame(rows, _ENTRIES).coalesce(1).write.mode("append").json(self.path)

    def holds(self, name: str, load_id: str) -> bool:
        return not self.loads(name).filter(F.col("load_id") == load_id).isEmpty()

    def loads(self, name: str, since: str | None = None) -> DataFrame:
        """Ids of the loads of a table, those from a day on if ``since`` is given."""
        found = self.entries().filter(F.col("table_name") == name).select("load_id").distinct()
        return found if since is None else found.filter(F.col("load_id") >= since)
