"""Marts, reports and narratives stored by month and offered to every session of a catalog.

``refresh`` rewrites the months a merge has touched and leaves the others as they
are; ``register`` makes the stored tables known under a database, with a view and
a table function for each: ``SELECT * FROM report_monthly('1998-06')`` after ``USE
retail``, since Spark finds table functions in the current database only. These live in
the catalog, so a session that lacks this package can ask them. A refresh replaces one table after the other; readers may meanwhile see new months of one
table beside old ones of another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_of
from ..operators.selectors import checked_months, dated_in_months, in_months
from ..sources.monthly import LIVE, replace_months
from . import narratives, reports
from .registry import MARTS
from .sales import Tables

STORED_MONTH = "stored_month"
WHOLE = "all"
_MONTH_COLUMNS = ("sale_month", "report_month", "plan_month", "trend_month", "month")
_DAY_COLUMNS = ("inventory_date", "report_date")


@dataclass(frozen=True)
class Stored:
    """How a table is computed for some months, or for all of them.

    ``whole`` tables have no month and are computed anew; those that compare
    with earlier months are computed from the first touched month on.
    """

    build: Callable[[Tables, tuple[str, ...] | None], DataFrame]
    whole: bool = False
    looks_back: bool = False


def _of_months(tables: Tables, months: tuple[str, ...] | None) -> Tables:
    """Facts of some months; rates and dimensions stay as they are."""
    return {
        **{name: tables[name] for name in ("stores", "products", "currency_rates")},
        "sales": in_months(tables["sales"], "sale_month", months),
        "plan_sales": in_months(tables["plan_sales"], "plan_month", months),
        "inventory": dated_in_months(tables["inventory"], "inventory_date", months),
    }


def _report(function: Callable[[Tables], DataFrame]) -> Stored:
    return Stored(lambda tables, months: function(_of_months(tables, months)))


REPORTS = {
    name: _report(getattr(reports, name))
    for name in ("report_monthly", "report_plan_fact", "report_inventory")
}
STORED: dict[str, Stored] = {
    **{
        name: Stored(
            mart, whole=name == "abc_xyz_analysis",
            looks_back=name in ("sales_fx_monthly", "fx_risk_metrics"))
        for name, mart in MARTS.items()
    },
    **REPORTS,
    **{
        name: _report(getattr(narratives, name))
        for name in ("narrative_monthly", "narrative_plan_fact", "narrative_inventory",
                     "facts_monthly", "facts_plan_fact", "facts_inventory")
    },
}


def _period(rows: DataFrame) -> str | None:
    return next((c for c in (*_MONTH_COLUMNS, *_DAY_COLUMNS) if c in rows.columns), None)


def _month(rows: DataFrame, stored: Stored) -> Column:
    period = None if stored.whole else _period(rows)
    if period is None:
        return F.lit(WHOLE)
    return month_of(period) if period in _DAY_COLUMNS else F.col(period)


def _from(tables: Tables, first: str) -> tuple[str, ...]:
    """The months with sales or rates from one on; one entry each."""
    days = tables["currency_rates"].select(month_of("rate_date").alias("m"))
    found = tables["sales"].select(F.col("sale_month").alias("m")).union(days)
    return tuple(r.m for r in found.filter(F.col("m") >= first).distinct().collect())


def refresh(
    tables: Tables, root: str, months: Iterable[str] | None = None,
    names: Sequence[str] = tuple(STORED),
) -> None:
    """Store the given months of the tables anew, or everything without any.

    ``tables`` are the core tables after the merge. A change of a dimension
    may show in any month: give no months then.
    """
    months = checked_months(months)
    if months == ():
        return
    for name in names:
        stored, wanted = STORED[name], months
        if stored.whole:
            wanted = None
        elif stored.looks_back and months is not None:
            wanted = tuple(sorted({*months, *_from(tables, min(months))}))
        rows = stored.build(tables, wanted)
        rows = rows.withColumn(STORED_MONTH, _month(rows, stored))
        replace_months(rows, f"{root}/{name}", STORED_MONTH, wanted)


def touched_months(changes: Iterable[tuple], rates: DataFrame | None = None) -> tuple[str, ...]:
    """Months of facts that a merge has written, from what it published, and those of staged rates."""
    found = {change[1] for change in changes if change[0] in ("sales", "plan_sales", "inventory")}
    if rates is not None:
        found |= {r.m for r in rates.select(month_of("rate_date").alias("m")).distinct().collect()}
    return tuple(sorted(found))


# ---- the catalog ----

def _plain(kind: T.DataType) -> T.DataType:
    """The type without remarks on nulls."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind])
    return kind


def _known(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return _plain(T.StructType([f for f in found if f.name != STORED_MONTH]))


def register(
    spark: SparkSession, root: str, database: str, names: Sequence[str] = tuple(STORED)
) -> list[str]:
    """Tables, views and functions over what ``refresh`` has stored; again after each refresh.

    Views show all periods. Functions take one, a month or (for stock) a day
    as text; those of reports always give a row, whose ``has_data`` is false if
    nothing is known of the period, as ``reports`` do.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for name in names:
        layout = _known(spark, f"{root}/{name}")
        if layout is None:
            continue
        made.append(name)
        table = f"{database}.{name}_by_month"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({layout.toDDL()}, {STORED_MONTH} STRING)"
            f" USING parquet PARTITIONED BY ({STORED_MONTH}) LOCATION '{root}/{name}'")
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)
        shown = [f for f in layout if f.name != LIVE]
        columns = ", ".join(f"`{f.name}`" for f in shown)
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {table} WHERE {LIVE}")
        period = next((f.name for f in shown if f.name in (*_MONTH_COLUMNS, *_DAY_COLUMNS)), None)
        if STORED[name].whole or period is None:
            continue
        by_day = period in _DAY_COLUMNS
        body = _asked(table, shown, columns, period, by_day, always=name in REPORTS)
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {database}.{name}(period STRING)"
            f" RETURNS TABLE ({T.StructType(shown).toDDL()}) RETURN {body}")
    return made


def _asked(
    table: str, shown: list[T.StructField], columns: str, period: str, by_day: bool, always: bool
) -> str:
    month = "substr(period, 1, 7)" if by_day else "period"
    value = "CAST(period AS DATE)" if by_day else "period"
    shape, style = (r"^\\d{4}-\\d{2}-\\d{2}$", "report date must be written YYYY-MM-DD") if by_day \
        else (r"^\\d{4}-\\d{2}$", "month must be written YYYY-MM")
    checked = f"assert_true(period RLIKE '{shape}', '{style}') IS NULL"
    rows = (
        f"SELECT {columns} FROM {table} WHERE {checked} AND {LIVE}"
        f" AND {STORED_MONTH} = {month} AND `{period}` = {value}"
    )
    if not always:
        return rows

    def filled(f: T.StructField) -> str:
        if f.name == period:
            return f"{value} AS `{f.name}`"
        if f.name == "has_data":
            return "coalesce(`has_data`, false) AS `has_data`"
        if isinstance(f.dataType, T.ArrayType):
            empty = f"CAST(array() AS {f.dataType.simpleString()})"
            return f"coalesce(`{f.name}`, {empty}) AS `{f.name}`"
        return f"`{f.name}`"

    return (
        f"SELECT {', '.join(map(filled, shown))} FROM (SELECT 1 AS asked WHERE {checked})"
        f" LEFT JOIN ({rows}) ON true"
    )
