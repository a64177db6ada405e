"""Several fact tables summed side by side on shared keys.

The usual way, one aggregate per table and a chain of full outer joins on
coalesced keys, shuffles every input at least once per join. Here the tables
are stacked with each other's measures left null and grouped once: a single
shuffle, combined on the map side, with no join to skew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import col, scaled, unscaled


@dataclass(frozen=True)
class Side:
    """One input: its key expressions in shared order and its measures.

    ``sums`` are added up; ``distinct``, a name and a column, is counted
    without repeats. A count of the side's rows is always given as
    ``<side>_rows``, from the column ``rows`` where the frame is already summed;
    both counts are zero when the side is absent.
    """

    frame: DataFrame
    keys: Sequence[Column | str]
    sums: Mapping[str, Column | str] = field(default_factory=dict)
    distinct: tuple[str, Column | str] | None = None
    rows: Column | str | None = None


def align(keys: Sequence[str], sides: Mapping[str, Side], nulls_meet: bool = False) -> DataFrame:
    """Full outer alignment of all sides on ``keys``.

    Sums of an absent side are null. As in a join, a null key equals nothing:
    rows with one stay apart from the other sides' rows. With ``nulls_meet`` they
    share a row, as if the joined rows had been grouped by the keys.
    """
    stacked = [
        _measured(name, side, keys).withColumn("_alone", F.when(_any_null(keys), F.lit(name)))
        for name, side in sides.items()
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    counts = [f"{name}_rows" for name in sides]
    counts += [side.distinct[0] for side in sides.values() if side.distinct]
    scales = {a: scale for side in sides.values() for a, scale in _scales(side).items()}
    aggregates = [
        unscaled(F.sum(f"{a}_high"), F.sum(f"{a}_low"), scales[a]).alias(a)
        if a in scales else F.sum(a).alias(a)
        for side in sides.values() for a in side.sums
    ]
    aggregates += [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]
    groups = keys if nulls_meet else [*keys, "_alone"]
    return rows.groupBy(*groups).agg(*aggregates).drop("_alone")


def _scales(side: Side) -> dict[str, int]:
    """Decimal measures that travel as whole numbers of their last digit.

    Wide decimal sums are kept as byte strings and cost several times a long.
    The number is summed in a high and a low part, so the sum may be far larger
    than a long.
    """
    kinds = side.frame.select(*(col(e).alias(a) for a, e in side.sums.items())).schema
    return {
        f.name: f.dataType.scale for f in kinds
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision <= 18
    }


def _measured(name: str, side: Side, keys: Sequence[str]) -> DataFrame:
    """Keys, measures and row count of one side, ready to be summed.

    Repeats are removed by grouping this side alone with the counted column,
    so the other sides do not travel through that shuffle.
    """
    named = [col(expr).alias(key) for key, expr in zip(keys, side.keys, strict=True)]
    scales = _scales(side)
    measures: dict[str, Column] = {}
    for a, e in side.sums.items():
        measures |= scaled(e, scales[a], a) if a in scales else {a: col(e)}
    shown = [e.alias(a) for a, e in measures.items()]
    rows = f"{name}_rows"
    number = F.lit(1) if side.rows is None else col(side.rows)
    shown.append(number.cast("bigint").alias(rows))
    if side.distinct is None:
        return side.frame.select(*named, *shown)
    label, counted = side.distinct
    return (
        side.frame.select(*named, *shown, col(counted).alias("_counted"))
        .groupBy(*keys, "_counted")
        .agg(*(F.sum(a).alias(a) for a in (*measures, rows)))
        .withColumn(label, F.col("_counted").isNotNull().cast("bigint"))
        .drop("_counted")
    )


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
