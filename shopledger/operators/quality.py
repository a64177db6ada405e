"""Declared constraints checked on data: required columns, number widths and unique keys.

Rows cleaned with ``overflow=True`` name the columns whose number was too
large; these break the rule ``precision`` and aren't counted as missing.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENTITIES, Entity
from .cleaning import OVERFLOWED


class QualityError(ValueError):
    """A staged table breaks one of its declared constraints."""


def _entity(entity: Entity | str) -> Entity:
    return ENTITIES[entity] if isinstance(entity, str) else entity


def _counts(entity: Entity, overflow: bool) -> dict[tuple[str, str], Column]:
    """Aggregates by rule and column; none of them needs a shuffle of rows."""
    return {at: F.count_if(rule) for at, rule in _broken(entity, overflow).items()}


def _broken(entity: Entity, overflow: bool) -> dict[tuple[str, str], Column]:
    """Whether a row breaks a rule, by rule and column."""
    def too_large(c: str) -> Column:
        return F.array_contains(OVERFLOWED, c) if overflow else F.lit(False)

    broken = {("not_null", c): F.col(c).isNull() & ~too_large(c) for c in entity.not_null}
    if overflow:
        broken |= {
            ("precision", f.name): too_large(f.name) for f in entity.staged
            if isinstance(f.dataType, (T.DecimalType, T.IntegralType))
        }
    return broken


def _repeats(entity: Entity, rows: DataFrame) -> DataFrame:
    """Rows that share a key, counted with map-side combining."""
    return (
        rows.groupBy(*entity.key).count().filter("count > 1")
        .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("bad_rows"))
        .select(F.lit("unique").alias("rule"), F.lit(", ".join(entity.key)).alias("columns"),
                "bad_rows")
    )


def _violations_by_key(entity: Entity, rows: DataFrame) -> DataFrame:
    """Counts and repeats in one pass over rows that lie by their key, as cleaned ones do.

    The broken rules of a row travel as the bits of a number.
    """
    broken = _broken(entity, True)
    bits = reduce(lambda a, b: a.bitwiseOR(b), (
        F.when(rule, F.lit(1 << place)).otherwise(F.lit(0)).cast("bigint")
        for place, rule in enumerate(broken.values())))
    copies = F.count(F.lit(1)).over(Window.partitionBy(*entity.key))
    kinds = (
        rows.select(*entity.key, bits.alias("_broken")).withColumn("_copies", copies)
        .groupBy("_broken")
        .agg(F.count(F.lit(1)).alias("_rows"), F.count_if(F.col("_copies") > 1).alias("_repeated"))
    )
    none = F.lit(0).cast("bigint")
    entries = [
        (rule, c, F.sum(F.when(F.getbit("_broken", F.lit(place)) == 1, F.col("_rows"))))
        for place, (rule, c) in enumerate(broken)
    ] + [("unique", ", ".join(entity.key), F.sum("_repeated"))]
    return kinds.agg(F.array(*(
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("columns"),
                 F.coalesce(n, none).alias("bad_rows"))
        for rule, c, n in entries
    )).alias("counts")).select(F.inline("counts"))


def violations(entity: Entity | str, rows: DataFrame) -> DataFrame:
    """One row per broken rule: ``(table_name, rule, columns, bad_rows)``.

    Counts of all columns come from one pass; key repeats are counted
    with map-side combining, so a heavily repeated key costs no more. Cleaned
    rows lie by their key, which they hold once: one pass gives all of it.
    """
    entity = _entity(entity)
    if OVERFLOWED in rows.columns:
        found = _violations_by_key(entity, rows)
    else:
        counts = rows.agg(F.array(*(
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("columns"), n.alias("bad_rows"))
            for (rule, c), n in _counts(entity, False).items()
        )).alias("counts")).select(F.inline("counts"))
        found = counts.unionByName(_repeats(entity, rows))
    return found.filter("bad_rows > 0").select(
        F.lit(entity.name).alias("table_name"), "rule", "columns", "bad_rows")


def watched(entity: Entity | str, rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and counts of broken rules that Spark gathers while they are written."""
    entity = _entity(entity)
    seen = Observation()
    counts = _counts(entity, OVERFLOWED in rows.columns)
    return rows.observe(seen, *(n.alias(f"{rule} {c}") for (rule, c), n in counts.items())), seen


def enforce(
    entity: Entity | str, rows: DataFrame, seen: Observation | Mapping[str, int] | None = None
) -> None:
    """Raise if any constraint is broken (at most one row per rule is read).

    With what was ``seen`` while the rows were written only their keys are read.
    """
    entity = _entity(entity)
    if seen is None:
        broken = [(r.rule, r["columns"], r.bad_rows) for r in violations(entity, rows).collect()]
    else:
        counts = seen.get if isinstance(seen, Observation) else seen
        broken = [(*name.split(" ", 1), n) for name, n in counts.items() if n]
        repeats = _repeats(entity, rows).first()
        if repeats.bad_rows:
            broken.append((repeats.rule, repeats["columns"], repeats.bad_rows))
    if broken:
        text = "; ".join(f"{rule}({columns}): {n} rows" for rule, columns, n in broken)
        raise QualityError(f"{entity.name}: {text}")


def split_rejects(entity: Entity | str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit to load, and the rest with the names of their null columns.

    A null where a number was too large is among them; ``overflowed_columns``
    tells these apart if the rows carry it.
    """
    entity = _entity(entity)
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in entity.not_null))
    missing = F.concat_ws(
        ", ", *(F.when(F.col(c).isNull(), F.lit(c)) for c in entity.not_null)
    )
    return rows.filter(complete), rows.filter(~complete).withColumn("missing_columns", missing)
