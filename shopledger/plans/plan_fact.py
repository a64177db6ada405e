"""Plan versus fact.

Plans are kept per month, store and category. Some marts join a plan to the
single sale rows of its cell before summing, which counts the plan once per
sale. That figure is part of the contract, so it is reproduced, but from one
aligned row per cell: the plan times the number of its sales. ``plan_once``
gives the undistorted figure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import TOTAL, or_zero, pct, total
from ..operators.aligning import Side, align
from ..operators.selectors import in_months, over_months
from ..operators.sharing import zero_of_all
from .sales import STORE_NAMES, Months, Tables, sales_of, with_store

CELL = ("plan_month", "store_id", "category")
PLAN = ("plan_revenue", "plan_profit", "plan_qty")
FACT = ("fact_revenue", "fact_profit", "fact_qty")
_MONEY = ("plan_revenue", "plan_profit", "fact_revenue", "fact_profit")


def plan_of(tables: Tables, months: Months = None) -> DataFrame:
    return in_months(tables["plan_sales"], "plan_month", months)


def _aligned(tables: Tables, months: Months, keys: tuple[str, ...]) -> DataFrame:
    """Plan and fact sums on ``keys`` from one shuffle over both tables."""
    sale_keys = ["sale_month" if k == "plan_month" else k for k in keys]
    return align(
        keys,
        {
            "sales": Side(
                sales_of(tables, months), sale_keys,
                {"fact_revenue": "revenue", "fact_profit": "profit", "fact_qty": "quantity"},
            ),
            "plan": Side(plan_of(tables, months), keys, {c: c for c in PLAN}),
        },
    )


def cells_of(sales: DataFrame, tables: Tables, months: Months) -> DataFrame:
    """As ``cells``, from sales already summed by month, store and category.

    ``sales`` has one or more rows per cell with ``sales_rows``, the number of
    sales in each, and is read in all its columns.
    """
    revenue = (F.col("revenue") + zero_of_all(sales)).cast(TOTAL)
    return align(
        CELL,
        {
            "sales": Side(
                sales, ["sale_month", "store_id", "category"],
                {"fact_revenue": revenue, "fact_profit": "profit", "fact_qty": "quantity"},
                rows="sales_rows",
            ),
            "plan": Side(plan_of(tables, months), CELL, {c: c for c in PLAN}),
        },
    )


def cells(tables: Tables, months: Months = None) -> DataFrame:
    """Every month, store and category that has a plan or a sale.

    Tables whose plans follow from their sales may align both themselves.
    """
    derived = getattr(tables, "plan_fact_cells", None)
    return _aligned(tables, months, CELL) if derived is None else derived(months)


def weighted_measures(plan_once: bool = False) -> dict[str, Column]:
    """Measures of a planned cell as a join to its sale rows would sum them."""
    repeats = F.lit(1) if plan_once else F.greatest("sales_rows", F.lit(1))
    return {c: F.col(c) * repeats for c in PLAN} | {
        c: or_zero(c) * F.col("plan_rows") for c in FACT
    }


def planned(aligned: DataFrame, plan_once: bool = False) -> DataFrame:
    return aligned.filter("plan_rows > 0").withColumns(weighted_measures(plan_once))


def plan_fact_sums() -> list[Column]:
    return [
        (total(c) if c in _MONEY else F.sum(c).cast("bigint")).alias(c) for c in PLAN + FACT
    ]


def _completion(df: DataFrame, prefix: str, suffix: str) -> DataFrame:
    return df.withColumns({
        f"{prefix}revenue{suffix}": pct("fact_revenue", "plan_revenue"),
        f"{prefix}profit{suffix}": pct("fact_profit", "plan_profit"),
    })


def _with_variance(df: DataFrame) -> DataFrame:
    variances = df.withColumns({
        "revenue_variance": (F.col("fact_revenue") - F.col("plan_revenue")).cast(TOTAL),
        "profit_variance": (F.col("fact_profit") - F.col("plan_profit")).cast(TOTAL),
    })
    return _completion(variances, "", "_plan_completion_pct")


@over_months
def category_plan_fact(tables: Tables, months: Months = None) -> DataFrame:
    """Category by month, driven by plans; each plan counts once."""
    both = _aligned(tables, months, ("plan_month", "category")).filter("plan_rows > 0")
    both = both.withColumns({c: or_zero(c) for c in FACT})
    return _with_variance(both).select(
        F.col("plan_month").alias("report_month"), "category", *PLAN, *FACT,
        "revenue_variance", "profit_variance",
        "revenue_plan_completion_pct", "profit_plan_completion_pct",
    )


@over_months
def plan_fact_dashboard(
    tables: Tables, months: Months = None, plan_once: bool = False
) -> DataFrame:
    """Month, store and category with store attributes (plan per sale row)."""
    weighted = planned(cells(tables, months), plan_once)
    typed = weighted.withColumns(
        {c: F.col(c).cast(TOTAL if c in _MONEY else "bigint") for c in PLAN + FACT}
    )
    return with_store(_with_variance(typed), tables).select(
        "plan_month", "store_id", *STORE_NAMES, "category", *PLAN, *FACT,
        "revenue_variance", "profit_variance",
        "revenue_plan_completion_pct", "profit_plan_completion_pct",
    )


@over_months
def plan_fact_trend(tables: Tables, months: Months = None) -> DataFrame:
    """All months with a plan or sales; completion is null without a plan."""
    both = _aligned(tables, months, ("plan_month",))
    completion = pct(or_zero("fact_revenue"), "plan_revenue")
    return (
        both.withColumn("revenue_plan_completion_pct", completion)
        .withColumns({c: or_zero(c) for c in PLAN + FACT})
        .select(
            F.col("plan_month").alias("trend_month"), *PLAN, *FACT,
            (F.col("fact_revenue") - F.col("plan_revenue")).cast(TOTAL).alias("revenue_variance"),
            "revenue_plan_completion_pct",
        )
    )


def completed(summed: DataFrame) -> DataFrame:
    return _completion(summed, "plan_", "_pct")


def _rolled_up(tables: Tables, months: Months, plan_once: bool, *keys: str) -> DataFrame:
    weighted = planned(cells(tables, months), plan_once)
    return completed(weighted.groupBy("plan_month", *keys).agg(*plan_fact_sums()))


@over_months
def plan_fact_summary(tables: Tables, months: Months = None, plan_once: bool = False) -> DataFrame:
    return _rolled_up(tables, months, plan_once).select(
        "plan_month", *PLAN, *FACT, "plan_revenue_pct", "plan_profit_pct"
    )


_RANKING = (
    "plan_revenue", "fact_revenue", "plan_revenue_pct",
    "plan_profit", "fact_profit", "plan_profit_pct",
)


@over_months
def plan_fact_store(tables: Tables, months: Months = None, plan_once: bool = False) -> DataFrame:
    return _rolled_up(tables, months, plan_once, "store_id").select(
        "plan_month", "store_id", *_RANKING
    )


@over_months
def plan_fact_category(tables: Tables, months: Months = None, plan_once: bool = False) -> DataFrame:
    return _rolled_up(tables, months, plan_once, "category").select(
        "plan_month", "category", *_RANKING
    )
