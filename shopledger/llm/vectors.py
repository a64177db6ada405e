"""Vectors between Spark and numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Neither null nor with a component that is null or not finite."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(column).isNotNull() & fine


def matrix(lists: pa.Array | pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    """One row for each list, filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    out = np.zeros((len(lists), width), kind)
    if len(lists):
        ends = np.asarray(lists.offsets)
        values, sizes = np.asarray(lists.values), np.diff(ends)
        row = np.repeat(np.arange(len(lists)), sizes)
        out[row, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)] = values[ends[0] : ends[-1]]
    return out
