"""Session defaults used by the tests and the benchmark.

The library itself never builds a session; it works on whichever one the
caller passes and reads cluster settings from there.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "shopledger", cores: int | str = 8, memory: str = "8g") -> SparkSession:
    width = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(width))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # no Python call site per expression: building a wide mart gets faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
