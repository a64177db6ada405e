"""Management reports: one row per period, short lists nested inside.

All periods are computed in one pass; asking for a single period filters the
inputs and always returns one row, with ``has_data`` false when nothing is
known about it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import plan_status as status_of
from ..functions.numbers import or_zero, pct, total
from ..operators.selectors import check_date, check_month, over_months
from ..operators.topk import as_lists, top_k
from .inventory import inventory_alerts, inventory_summary
from .plan_fact import (
    FACT, PLAN, cells, completed, plan_fact_category, plan_fact_store, plan_fact_sums,
    plan_fact_summary, weighted_measures,
)
from .sales import Months, Tables, category_monthly, store_monthly

STORE_FIELDS = ("store_id", "revenue", "profit", "quantity")
CATEGORY_FIELDS = ("category", "revenue", "profit", "quantity")
PLAN_FIELDS = (
    "plan_revenue", "fact_revenue", "plan_revenue_pct",
    "plan_profit", "fact_profit", "plan_profit_pct",
)
POSITION_FIELDS = (
    "store_id", "product_id", "stock_qty", "stock_value", "reorder_point", "days_of_cover",
    "stock_status",
)


# ---- rankings: the best or worst of every period, ties settled by name ----

def _by_revenue(rows: DataFrame, key: str, best: bool, k: int) -> DataFrame:
    revenue = F.desc("revenue") if best else F.asc("revenue")
    return top_k(rows, ["sale_month"], [revenue, F.asc(key)], k)


def _by_completion(rows: DataFrame, key: str, k: int) -> DataFrame:
    """Lowest completion first; a plan of zero has none and goes last."""
    return top_k(rows, ["plan_month"], [F.asc_nulls_last("plan_revenue_pct"), F.asc(key)], k)


@over_months
def top_stores(tables: Tables, months: Months = None, k: int = 3) -> DataFrame:
    return _by_revenue(store_monthly(tables, months), "store_id", True, k)


@over_months
def low_stores(tables: Tables, months: Months = None, k: int = 3) -> DataFrame:
    return _by_revenue(store_monthly(tables, months), "store_id", False, k)


@over_months
def top_categories(tables: Tables, months: Months = None, k: int = 3) -> DataFrame:
    return _by_revenue(category_monthly(tables, months), "category", True, k)


@over_months
def low_categories(tables: Tables, months: Months = None, k: int = 3) -> DataFrame:
    return _by_revenue(category_monthly(tables, months), "category", False, k)


@over_months
def worst_stores_by_plan(tables: Tables, months: Months = None, k: int = 5) -> DataFrame:
    return _by_completion(plan_fact_store(tables, months), "store_id", k)


@over_months
def worst_categories_by_plan(tables: Tables, months: Months = None, k: int = 5) -> DataFrame:
    return _by_completion(plan_fact_category(tables, months), "category", k)


def _most_valuable(rows: DataFrame, k: int) -> DataFrame:
    order = [F.desc("stock_value"), F.asc("store_id"), F.asc("product_id")]
    return top_k(rows, ["inventory_date", "stock_status"], order, k)


@over_months
def low_stock_top(tables: Tables, months: Months = None, k: int = 10) -> DataFrame:
    return _most_valuable(inventory_alerts(tables, months).filter("stock_status = 'LOW'"), k)


@over_months
def overstock_top(tables: Tables, months: Months = None, k: int = 10) -> DataFrame:
    return _most_valuable(inventory_alerts(tables, months).filter("stock_status = 'OVERSTOCK'"), k)


@over_months
def plan_status(tables: Tables, months: Months = None) -> DataFrame:
    """Whether each month's plan was met, by revenue and by profit."""
    return plan_fact_summary(tables, months).select(
        "plan_month", "plan_revenue_pct", "plan_profit_pct",
        status_of("plan_revenue_pct").alias("revenue_status"),
        status_of("plan_profit_pct").alias("profit_status"),
    )


# ---- reports ----

def _lists_never_null(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: F.coalesce(F.col(f.name), F.array().cast(f.dataType))
        for f in df.schema if isinstance(f.dataType, T.ArrayType)
    })


def _finish(periods: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    report = periods
    for part in parts:
        report = report.join(part, key, "left")
    return _with_knowledge(report)


def _with_knowledge(report: DataFrame) -> DataFrame:
    report = _lists_never_null(report)
    known: Column = F.lit(False)
    for f in report.schema:
        if isinstance(f.dataType, T.ArrayType):
            known = known | (F.size(f.name) > 0)
        elif isinstance(f.dataType, T.StructType):
            known = known | F.col(f.name).isNotNull()
    return report.withColumn("has_data", known)


_SOLD = {"revenue": "fact_revenue", "profit": "fact_profit", "quantity": "fact_qty"}
# grouping ids over (month, store, category): a set bit is a column summed away
_MONTH, _STORE, _CATEGORY = 0b011, 0b001, 0b010


def _rollup(tables: Tables, month: str | None) -> DataFrame:
    """Sales and plan totals by month, by store and by category.

    Plans are weighted in the finest cells, which are then summed to all three
    levels at once.
    """
    months = None if month is None else [check_month(month)]
    has_plan = F.col("plan_rows") > 0
    measured = cells(tables, months).select(
        F.col("plan_month").alias("month"), "store_id", "category", "sales_rows",
        *(or_zero(c).alias(name) for name, c in _SOLD.items()),
        *(F.when(has_plan, e).alias(c) for c, e in weighted_measures().items()),
        has_plan.cast("bigint").alias("plan_cells"),
    )
    levels = [["month"], ["month", "store_id"], ["month", "category"]]
    return measured.groupingSets(levels, "month", "store_id", "category").agg(
        total("revenue").alias("revenue"),
        total("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
        F.sum("sales_rows").alias("sales_count"),
        F.sum("plan_cells").alias("plan_cells"),
        *plan_fact_sums(),
        F.grouping_id().alias("level"),
    )


_SALES, _PLANS = "sales_count", "plan_cells"
_SORTED = "decimal(26,2)"


@dataclass(frozen=True)
class _Part:
    """One entry of a report: a struct, or with a sort the list of the first rows.

    Rows come in the order of ``sort``, nulls last, then of ``name``.
    """

    level: int
    having: str
    fields: tuple[str, ...]
    sort: Column | None = None
    name: str | None = None


def _folded(rollup: DataFrame, parts: Mapping[str, _Part], k: int) -> DataFrame:
    """One row per month with all parts.

    A total takes part in every list of its level; one ranking by month and list
    serves them all, and is cut to ``k`` rows in every map task before its shuffle.
    Completions are shown of the rows left, so they are taken of those only.
    """
    def entry(number: int, part: _Part) -> Column:
        eligible = (F.col("level") == part.level) & (F.col(part.having) > 0)
        sort = F.lit(None) if part.sort is None else part.sort
        name = F.lit(None) if part.name is None else F.col(part.name)
        return F.when(eligible, F.struct(
            F.lit(number).alias("part"), sort.cast(_SORTED).alias("sort"),
            name.cast("string").alias("name"),
        ))

    # a month is shown as soon as anything is known of it
    known = F.when(F.col("level") == _MONTH, F.struct(
        F.lit(-1).alias("part"), F.lit(None).cast(_SORTED).alias("sort"),
        F.lit(None).cast("string").alias("name")))
    entries = F.array(known, *(entry(i, p) for i, p in enumerate(parts.values())))
    shown = dict.fromkeys(f for p in parts.values() for f in p.fields)
    fields = [f for f in dict.fromkeys([*shown, *PLAN, *FACT]) if f in rollup.columns]
    # entries not taken part in are filtered as rows: a filter of arrays is never compiled
    placed = rollup.select("month", *fields, F.inline(entries)).filter("part IS NOT NULL")
    # comparing wide decimals is slow; doubles, which never order them otherwise, settle most
    near = F.asc_nulls_last(F.col("sort").cast("double"))
    order = [near, F.asc_nulls_last("sort"), F.asc("name")]
    listed = completed(top_k(placed, ["month", "part"], order, k))

    def folded(number: int, name: str, part: _Part) -> Column:
        row = F.when(F.col("part") == number, F.struct("position", *part.fields))
        ordered = F.transform(
            F.sort_array(F.collect_list(row)),
            lambda e: F.struct(*(e[f].alias(f) for f in part.fields)),
        )
        return (F.get(ordered, F.lit(0)) if part.sort is None else ordered).alias(name)

    return listed.groupBy("month").agg(
        *(folded(i, name, part) for i, (name, part) in enumerate(parts.items()))
    )


def _monthly(folded: DataFrame, month: str | None) -> DataFrame:
    """The report of all months, or of one month whether it is known or not."""
    if month is not None:
        asked = folded.sparkSession.range(1).select(F.lit(month).alias("month"))
        folded = asked.join(folded, "month", "left")
    return _with_knowledge(folded)


def _ranked(level: int, fields: tuple[str, ...], best: bool) -> _Part:
    revenue = -F.col("revenue") if best else F.col("revenue")
    return _Part(level, _SALES, fields, revenue, fields[0])


def _behind(level: int, key: str) -> _Part:
    return _Part(level, _PLANS, (key, *PLAN_FIELDS), pct("fact_revenue", "plan_revenue"), key)


_PLAN_FACT = (*PLAN, *FACT, "plan_revenue_pct", "plan_profit_pct")


def report_monthly(tables: Tables, month: str | None = None, k: int = 3) -> DataFrame:
    """KPI, best and weakest stores and categories, and plan completion."""
    parts = {
        "kpi": _Part(_MONTH, _SALES, ("revenue", "profit", "quantity", "sales_count")),
        "top_stores": _ranked(_STORE, STORE_FIELDS, True),
        "low_stores": _ranked(_STORE, STORE_FIELDS, False),
        "top_categories": _ranked(_CATEGORY, CATEGORY_FIELDS, True),
        "low_categories": _ranked(_CATEGORY, CATEGORY_FIELDS, False),
        "plan_fact": _Part(_MONTH, _PLANS, _PLAN_FACT),
    }
    return _monthly(_folded(_rollup(tables, month), parts, k), month)


def report_plan_fact(tables: Tables, month: str | None = None, k: int = 5) -> DataFrame:
    """Plan completion and the stores and categories furthest behind.

    Over all periods this covers the months that have a plan.
    """
    parts = {
        "summary": _Part(_MONTH, _PLANS, _PLAN_FACT),
        "worst_stores_by_plan": _behind(_STORE, "store_id"),
        "worst_categories_by_plan": _behind(_CATEGORY, "category"),
    }
    folded = _folded(_rollup(tables, month), parts, k)
    if month is None:
        folded = folded.filter(F.col("summary").isNotNull())
    return _monthly(folded, month)


def report_inventory(
    tables: Tables, report_date: str | date | None = None, k: int = 10
) -> DataFrame:
    """Stock totals and the most valuable short and excess positions of a date."""
    day = None if report_date is None else check_date(report_date)
    source = dict(tables.items())
    if day is not None:
        source["inventory"] = source["inventory"].filter(F.col("inventory_date") == day)
    totals = inventory_summary(source)
    if day is None:
        periods = totals.select("inventory_date")
    else:
        spark = totals.sparkSession
        periods = spark.range(1).select(F.lit(day).alias("inventory_date"))
    parts = [
        totals.select(
            "inventory_date", F.struct("total_stock_qty", "total_stock_value").alias("summary")
        )
    ]
    status = F.col("stock_status")
    at_risk = inventory_alerts(source).filter(status.isin("LOW", "OVERSTOCK"))
    lists = {"low_stock": status == "LOW", "overstock": status == "OVERSTOCK"}
    parts.append(as_lists(_most_valuable(at_risk, k), "inventory_date", POSITION_FIELDS, lists))
    report = _finish(periods, parts, "inventory_date")
    return report.withColumnRenamed("inventory_date", "report_date")


# ---- machine-readable form ----

def _json_type(kind: T.DataType) -> T.DataType:
    """The type a JSON reader expects: decimals as numbers, dates as text."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_json_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _json_type(f.dataType), f.nullable) for f in kind]
        )
    return kind


def with_payload(report: DataFrame) -> DataFrame:
    """Add ``payload``: the report row as one JSON document."""
    fields = [
        F.col(f.name).cast(_json_type(f.dataType)).alias(f.name)
        for f in report.schema if f.name != "has_data"
    ]
    return report.withColumn("payload", F.to_json(F.struct(*fields)))
