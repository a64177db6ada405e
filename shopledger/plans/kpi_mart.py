"""Wide management marts joining sales, plan and stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..functions.labels import management
from ..functions.numbers import TOTAL, or_zero, pct, ratio, total
from ..operators.aligning import Side, align
from ..operators.ranking import with_ranks
from ..operators.sharing import zero_of_all
from .inventory import inventory_of
from .plan_fact import cells_of, plan_of, planned
from ..operators.selectors import over_months
from .sales import STORE_NAMES, Months, Tables, sales_of, with_product, with_store

_KEY = ("report_month", "store_id", "category")
_STATUSES = {"LOW": "low_stock", "OVERSTOCK": "overstock", "OK": "ok_stock"}


def _stock(tables: Tables, months: Months) -> DataFrame:
    """Stock per month, store and product with the product's category.

    Stock of a product missing from the dimension has no category.
    """
    status = F.col("stock_status")
    # summed by product first: the join that finds the category meets no single position
    by_product = (
        inventory_of(tables, months)
        .groupBy(month_of("inventory_date").alias("stock_month"), "store_id", "product_id")
        .agg(
            F.sum("stock_qty").alias("stock_qty"), total("stock_value").alias("stock_value"),
            total("days_of_cover").alias("cover_days"),
            *(F.count_if(status == s).alias(f"{n}_positions") for s, n in _STATUSES.items()),
            F.count(F.lit(1)).alias("positions"),
        )
    )
    return with_product(by_product, tables, "category")


def _cells(tables: Tables, months: Months) -> DataFrame:
    """Sales, plan and stock per month, store and category.

    Stock without a category keeps a row of its own.
    """
    aligned = align(
        _KEY,
        {
            "sales": Side(
                sales_of(tables, months), ["sale_month", "store_id", "category"],
                sums={
                    "fact_revenue": "revenue", "fact_cost": "total_cost",
                    "fact_profit": "profit", "fact_qty": "quantity",
                },
                distinct=("sold_products", "product_id"),
            ),
            "plan": Side(
                plan_of(tables, months), ["plan_month", "store_id", "category"],
                sums={c: c for c in ("plan_revenue", "plan_profit", "plan_qty")},
            ),
            "stock": Side(
                _stock(tables, months), ["stock_month", "store_id", "category"],
                sums={
                    c: c for c in (
                        "stock_qty", "stock_value", "cover_days",
                        *(f"{n}_positions" for n in _STATUSES.values()),
                    )
                },
                rows="positions",
            ),
        },
    )
    revenue_gap = or_zero("fact_revenue") - or_zero("plan_revenue")
    profit_gap = or_zero("fact_profit") - or_zero("plan_profit")
    shown_or_zero = (
        "fact_revenue", "fact_cost", "fact_profit", "fact_qty", "sales_rows", "sold_products",
    )
    return aligned.select(
        *_KEY,
        *(or_zero(c).alias(c) for c in shown_or_zero),
        or_zero(pct("fact_profit", "fact_revenue")).alias("margin_pct"),
        or_zero(ratio("fact_revenue", "fact_qty")).alias("avg_unit_revenue"),
        *(or_zero(c).alias(c) for c in ("plan_revenue", "plan_profit", "plan_qty")),
        revenue_gap.cast(TOTAL).alias("revenue_variance"),
        profit_gap.cast(TOTAL).alias("profit_variance"),
        pct(or_zero("fact_revenue"), "plan_revenue").alias("revenue_plan_completion_pct"),
        pct(or_zero("fact_profit"), "plan_profit").alias("profit_plan_completion_pct"),
        or_zero("stock_qty").alias("stock_qty"),
        or_zero("stock_value").cast(TOTAL).alias("stock_value"),
        or_zero(ratio("cover_days", "stock_rows")).alias("avg_days_of_cover"),
        *(or_zero(c).alias(c) for c in (
            "low_stock_positions", "overstock_positions", "ok_stock_positions",
        )),
        F.col("stock_rows").alias("inventory_positions"),
        ratio(or_zero("fact_revenue"), "stock_value", 4).alias("stock_turnover_revenue_ratio"),
        management(
            F.col("low_stock_positions"), F.col("overstock_positions"),
            F.col("fact_revenue"), F.col("plan_revenue"),
        ).alias("management_status"),
    )


@over_months
def retail_kpi_mart(tables: Tables, months: Months = None) -> DataFrame:
    rows = _cells(tables, months)
    measures = [c for c in rows.columns if c not in _KEY]
    return with_store(rows, tables).select(
        "report_month", "store_id", *STORE_NAMES, "category", *measures
    )


def _by_store(tables: Tables, months: Months) -> DataFrame:
    """What the cells of a month and store sum to.

    Only the mean cover is taken cell by cell; all else is summed by store at
    once, so neither sales nor plans are shuffled by category.
    """
    covered = (
        _stock(tables, months)
        .groupBy("stock_month", "store_id", "category")
        .agg(
            total("stock_value").alias("stock_value"),
            F.sum("low_stock_positions").alias("low_stock_positions"),
            F.sum("overstock_positions").alias("overstock_positions"),
            ratio(F.sum("cover_days"), F.sum("positions")).alias("cover"),
        )
        .withColumn("cover", F.nullif("cover", F.lit(0)))
    )
    aligned = align(
        ("report_month", "store_id"),
        {
            "sales": Side(
                sales_of(tables, months), ["sale_month", "store_id"],
                sums={"fact_revenue": "revenue", "fact_profit": "profit"},
            ),
            "plan": Side(
                plan_of(tables, months), ["plan_month", "store_id"],
                sums={"plan_revenue": "plan_revenue"},
            ),
            "stock": Side(
                covered, ["stock_month", "store_id"],
                sums={
                    "stock_value": "stock_value", "low_stock_positions": "low_stock_positions",
                    "overstock_positions": "overstock_positions", "cover": "cover",
                    "covered": F.col("cover").isNotNull().cast("bigint"),
                },
            ),
        },
        nulls_meet=True,
    )
    gap = or_zero("fact_revenue") - or_zero("plan_revenue")
    return aligned.select(
        "report_month", "store_id",
        *(or_zero(c).cast(TOTAL).alias(c) for c in ("fact_revenue", "fact_profit", "plan_revenue")),
        gap.cast(TOTAL).alias("revenue_variance"),
        or_zero("stock_value").cast(TOTAL).alias("stock_value"),
        or_zero("low_stock_positions").alias("low_stock_positions"),
        or_zero("overstock_positions").alias("overstock_positions"),
        ratio("cover", "covered").alias("avg_days_of_cover"),
    )


@over_months
def store_monthly_heatmap(tables: Tables, months: Months = None) -> DataFrame:
    """Store by month with its ranks among all stores of the month, known or not."""
    ranks = {
        "revenue_rank": -F.col("fact_revenue"),
        "profit_rank": -F.col("fact_profit"),
        "underplan_rank": F.col("revenue_variance"),
    }
    ranked = with_ranks(_by_store(tables, months), "report_month", ranks)
    return with_store(ranked, tables).select(
        "report_month", "store_id", *STORE_NAMES,
        "fact_revenue", "fact_profit", "plan_revenue", "revenue_variance",
        pct("fact_revenue", "plan_revenue").alias("revenue_plan_completion_pct"),
        pct("fact_profit", "fact_revenue").alias("margin_pct"),
        "stock_value", "low_stock_positions", "overstock_positions", "avg_days_of_cover",
        "revenue_rank", "profit_rank", "underplan_rank",
    )


@over_months
def dashboard_summary(tables: Tables, months: Months = None) -> DataFrame:
    """Month KPIs with plan completion and stock: one row per stock count date.

    Sales are summed once, by month, store and category; both the month's
    figures and the plan comparison come from those sums.
    """
    sales = (
        sales_of(tables, months)
        .groupBy(
            "sale_month", F.year("sale_date").alias("sale_year"),
            F.month("sale_date").alias("sale_month_num"), "store_id", "category",
        )
        .agg(
            total("revenue").alias("revenue"), total("profit").alias("profit"),
            F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("sales_rows"),
        )
    )
    weighted = planned(cells_of(sales, tables, months))
    # a month never empty: else the join would filter this use of the sales, and not the other
    known_month = F.coalesce("plan_month", F.lit("")).alias("sale_month")
    plan = weighted.groupBy(known_month).agg(
        total("plan_revenue").alias("plan_revenue"),
        total("fact_revenue").alias("fact_revenue"),
    ).withColumn("revenue_plan_completion_pct", pct("fact_revenue", "plan_revenue"))
    status = F.col("stock_status")
    stock = (
        inventory_of(tables, months)
        .groupBy(F.col("inventory_date").alias("latest_inventory_date"))
        .agg(
            F.sum("stock_qty").alias("total_stock_qty"),
            total("stock_value").alias("total_stock_value"),
            F.count_if(status == "LOW").alias("low_stock_positions"),
            F.count_if(status == "OVERSTOCK").alias("overstock_positions"),
        )
        .withColumn("sale_month", month_of("latest_inventory_date"))
    )
    kpi = (
        sales.groupBy("sale_month", "sale_year", "sale_month_num")
        .agg(
            total("revenue").alias("revenue"), total("profit").alias("profit"),
            (F.sum("quantity") + F.sum(zero_of_all(sales))).alias("quantity"),
        )
        .withColumn("margin_pct", pct("profit", "revenue"))
        .drop("sale_year", "sale_month_num")
    )
    return kpi.join(plan, "sale_month", "left").join(stock, "sale_month", "left").select(
        "sale_month", "revenue", "profit", "quantity", "margin_pct",
        "plan_revenue", "fact_revenue", "revenue_plan_completion_pct",
        "latest_inventory_date", "total_stock_qty", "total_stock_value",
        "low_stock_positions", "overstock_positions",
    )
