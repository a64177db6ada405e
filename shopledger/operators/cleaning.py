"""Landed text to typed staging rows.

The order of steps is part of the result: duplicates go first, so an unusable
first copy suppresses later good ones; numbers are filled before rounding;
incomplete rows are dropped last.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.parsing import (
    column_style, day_text, fits, known, narrow, parse, style_reader,
)
from ..schemas import ENTITIES, Entity

LANDING_ORDER = "landing_position"
OVERFLOWED = "overflowed_columns"


def one_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[Column | str], keep: str = "first"
) -> DataFrame:
    """Keep the first or last row of every key in ``order``.

    Rows whose key is incomplete are dropped: every caller requires its key.
    ``row_number() = 1`` is pruned by Spark inside each map task before the
    shuffle, so a key with very many copies sends one row per task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    if keep == "last":
        order = [c.desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return (
        df.dropna(subset=list(key)).withColumn("_copy", rank).filter("_copy = 1").drop("_copy")
    )


def clean(
    entity: Entity | str, landed: DataFrame, order: Sequence[Column | str] = (LANDING_ORDER,),
    per: Sequence[str] = (), dates: str = "each", overflow: bool = False,
    text: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Typed, de-duplicated and complete rows of one landed table.

    Columns named in ``per`` separate loads that are cleaned independently;
    they stay on the result. ``dates="each"`` reads every day by what it looks
    like; ``dates="column"`` finds the one format that reads most values of a
    column of a load, and nothing else of that column is readable then.
    ``overflow`` adds the names of the columns whose number was too large, and
    keeps such rows even where the number is required. Where ``landed`` holds only
    keys, order and what the other columns follow from, ``text`` gives rows these
    columns: repeats go first, so the derived texts are neither sorted nor shuffled.
    """
    if dates not in ("each", "column"):
        raise ValueError("dates are read 'each' for itself or by 'column'")
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    rows = _typed(entity, landed, order, per, dates, text)
    if not overflow:
        return rows.drop(OVERFLOWED).dropna(subset=list(entity.required))
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in entity.required))
    return rows.filter(complete | (F.size(OVERFLOWED) > 0))


def dropped(
    entity: Entity | str, landed: DataFrame, order: Sequence[Column | str] = (LANDING_ORDER,)
) -> DataFrame:
    """Rows that ``clean`` leaves out although their key is the first of its kind.

    One row per reason: ``(table_name, reason, rows)``. A row may lack several
    required columns and is then counted under each.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    keyed = landed.withColumns({n: known(n) for n in entity.key})
    single = one_per_key(keyed, entity.key, order, entity.keep).select(
        F.lit(None).cast("boolean").alias("typed"),
        *(F.lit(True).alias(c) for c in entity.required),
    )
    typed = _typed(entity, landed, order, ()).select(
        F.lit(True).alias("typed"), *(F.col(c).isNotNull().alias(c) for c in entity.required)
    )
    counts = single.unionByName(typed).agg(
        F.count_if(F.col("typed").isNull()).alias("_single"), F.count_if("typed").alias("_typed"),
        *(F.count_if(~F.col(c)).alias(c) for c in entity.required),
    )
    out_of_range = F.col("_single") - F.col("_typed")
    entries = [F.struct(F.lit("out of range").alias("reason"), out_of_range.alias("rows"))] + [
        F.struct(F.lit(f"no usable {c}").alias("reason"), F.col(c).alias("rows"))
        for c in entity.required
    ]
    return counts.select(
        F.lit(entity.name).alias("table_name"), F.inline(F.array(*entries))
    ).filter("rows > 0")


def date_styles(
    entity: Entity | str, landed: DataFrame, per: Sequence[str] = ()
) -> DataFrame | None:
    """The format of each date column, by load: one pass over the rows that counts equal days,
    which are then read once in every format."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    dated = [f.name for f in entity.staged if isinstance(f.dataType, (T.DateType, T.TimestampNTZType))]
    if not dated:
        return None
    written = F.array(*(
        F.struct(F.lit(c).alias("_column"), day_text(known(c)).alias("_day")) for c in dated))
    days = landed.select(*per, F.inline(written)).groupBy(*per, "_column", "_day").agg(
        F.count(F.lit(1)).alias("_times"))
    styles = F.struct(*(
        column_style(F.when(F.col("_column") == c, F.col("_day")), "_times").alias(c)
        for c in dated
    )).alias(_STYLES)
    return days.groupBy(*per).agg(styles)


_STYLES = "date_styles"


def _readers(styles: DataFrame | None) -> DataFrame | None:
    """The found formats as what reads them, the same for all rows of a load."""
    if styles is None:
        return None
    found = styles.schema[_STYLES].dataType.names
    return styles.withColumn(
        _STYLES, F.struct(*(style_reader(F.col(_STYLES)[c]).alias(c) for c in found)))


def _typed(
    entity: Entity, landed: DataFrame, order: Sequence[Column | str], per: Sequence[str],
    dates: str = "each", text: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows as ``clean`` gives them, with those that miss something required."""
    # only the key decides which copy stays; the rest is read from survivors
    keyed = landed.withColumns({n: known(n) for n in entity.key})
    single = one_per_key(keyed, [*entity.key, *per], order, entity.keep)
    if text is not None:
        single, landed = _apart(text(single)), text(landed)
    styles = _readers(date_styles(entity, landed, per)) if dates == "column" else None
    if styles is not None and per:
        same = [single[c].eqNullSafe(styles[c]) for c in per]
        single = single.join(styles, reduce(lambda a, b: a & b, same)).select(
            *(single[c] for c in single.columns), styles[_STYLES])
    elif styles is not None:
        single = single.withColumn(_STYLES, styles.scalar())
    style = None if styles is None else F.col(_STYLES)

    def read(f: T.StructField) -> Column:
        if f.name in entity.key and isinstance(f.dataType, T.StringType):
            return F.col(f.name)  # known already; rows still lie by it
        dated = isinstance(f.dataType, (T.DateType, T.TimestampNTZType))
        return parse(known(f.name), f.dataType, style[f.name] if dated and style is not None else None)

    # apart, since one step that reads and rounds all columns is too long to be compiled by the JVM
    parsed = _apart(single.select(*(read(f).alias(f.name) for f in entity.staged), *per))
    if entity.name == "sales":
        # judged on the rounded price and revenue but on the uncut quantity,
        # so half a unit passes here and is cut to zero below
        parsed = parsed.filter(
            (F.col("quantity") > 0)
            & (F.round("unit_price", 2) >= 0)
            & (F.round("revenue", 2) >= 0)
        )
    return parsed.select(
        *(
            narrow(_filled(entity, f.name), f.dataType).cast(f.dataType).alias(f.name)
            for f in entity.staged
        ),
        *per,
        overflowed(entity).alias(OVERFLOWED),
    )


def _apart(rows: DataFrame) -> DataFrame:
    """The rows, whose columns Spark computes once: neither filters nor readers above
    are merged into their expressions. Counting the rows as they pass does that."""
    return rows.observe(f"kept_{uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def overflowed(entity: Entity) -> Column:
    """Names of the columns whose wide number has no room in their type."""
    numeric = [f for f in entity.staged if isinstance(f.dataType, (T.DecimalType, T.IntegralType))]
    return F.array_compact(F.array(*(
        F.when(~fits(F.col(f.name), f.dataType), F.lit(f.name)) for f in numeric
    )))


def _filled(entity: Entity, name: str) -> Column:
    value = F.col(name)
    return F.coalesce(value, F.lit(entity.fill[name])) if name in entity.fill else value


def clean_stores(landed: DataFrame, order=(LANDING_ORDER,)) -> DataFrame:
    return clean("stores", landed, order)


def clean_products(landed: DataFrame, order=(LANDING_ORDER,)) -> DataFrame:
    return clean("products", landed, order)


def clean_sales(landed: DataFrame, order=(LANDING_ORDER,)) -> DataFrame:
    return clean("sales", landed, order)


def clean_inventory(landed: DataFrame, order=(LANDING_ORDER,)) -> DataFrame:
    return clean("inventory", landed, order)


def clean_plan(landed: DataFrame, order=(LANDING_ORDER,)) -> DataFrame:
    return clean("plan_sales", landed, order)


def clean_rates(landed: DataFrame, order=("load_dttm", LANDING_ORDER)) -> DataFrame:
    """The last load of a rate wins."""
    return clean("currency_rates", landed, order)
