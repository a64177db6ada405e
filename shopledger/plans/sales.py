"""Sales marts: enriched rows and KPIs by month, store and category."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_weekend, weekday_from_sunday
from ..functions.numbers import TOTAL, pct, ratio, total
from ..operators.selectors import in_months, over_months
from ..operators.sharing import zero_of_all

Tables = Mapping[str, DataFrame]
Months = Iterable[str] | None

STORE_NAMES = ("store_name", "city", "region", "store_format")


def sales_of(tables: Tables, months: Months = None) -> DataFrame:
    return in_months(tables["sales"], "sale_month", months)


def store_attributes(tables: Tables, *extra: str) -> DataFrame:
    return tables["stores"].select(
        "store_id", "store_name", "city", "region", F.col("format").alias("store_format"), *extra
    )


def with_store(df: DataFrame, tables: Tables, *extra: str) -> DataFrame:
    """Attach store attributes; rows of unknown stores stay with nulls."""
    return df.join(store_attributes(tables, *extra), "store_id", "left")


def with_product(df: DataFrame, tables: Tables, *columns: str) -> DataFrame:
    return df.join(tables["products"].select("product_id", *columns), "product_id", "left")


@over_months
def sales_enriched(tables: Tables, months: Months = None) -> DataFrame:
    """Every sale with calendar, store and product attributes and unit ratios.

    The category is the one recorded on the sale, not the product's.
    """
    rows = with_store(sales_of(tables, months), tables, "store_area_sqm", "employees_count")
    rows = with_product(
        rows, tables, "product_name", "stock_code", "subcategory", "brand", "supplier", "uom"
    )
    stamp = ["updated_at"] if "updated_at" in rows.columns else []
    return rows.select(
        "sale_id", "sale_date", "sale_month",
        F.year("sale_date").alias("sale_year"),
        F.quarter("sale_date").alias("sale_quarter"),
        F.month("sale_date").alias("sale_month_num"),
        F.weekofyear("sale_date").alias("sale_week"),
        weekday_from_sunday("sale_date").alias("day_of_week_num"),
        is_weekend("sale_date").alias("is_weekend"),
        "store_id", *STORE_NAMES, "store_area_sqm", "employees_count",
        "product_id", "product_name", "stock_code", "category", "subcategory", "brand",
        "supplier", "uom", "sales_channel", "quantity", "revenue", "total_cost", "profit",
        pct("profit", "revenue").alias("margin_pct"),
        ratio("revenue", "quantity").alias("avg_unit_revenue"),
        ratio("profit", "quantity").alias("profit_per_unit"),
        ratio("revenue", "employees_count").alias("revenue_per_employee"),
        ratio("revenue", "store_area_sqm").alias("revenue_per_sqm"),
        *stamp,
    )


@over_months
def monthly_sales_kpi(tables: Tables, months: Months = None) -> DataFrame:
    """Month totals; reads sales only, as no dimension attribute is shown.

    Counting two columns without repeats triples every row it reads, so sales
    are summed by store and product first.
    """
    month = ("sale_month", "sale_year", "sale_month_num")
    return (
        sales_of(tables, months)
        .groupBy(
            "sale_month",
            F.year("sale_date").alias("sale_year"),
            F.month("sale_date").alias("sale_month_num"),
            "store_id", "product_id",
        )
        .agg(
            *(total(c).alias(c) for c in ("revenue", "total_cost", "profit")),
            F.sum("quantity").alias("quantity"),
            F.count(F.lit(1)).alias("sales_rows"),
        )
        .groupBy(*month)
        .agg(
            *(total(c).alias(c) for c in ("revenue", "total_cost", "profit")),
            F.sum("quantity").alias("quantity"),
            F.sum("sales_rows").alias("sales_rows"),
            F.count_distinct("store_id").alias("active_stores"),
            F.count_distinct("product_id").alias("active_products"),
        )
        .withColumn("margin_pct", pct("profit", "revenue"))
        .withColumn("avg_sale_row_revenue", ratio("revenue", "sales_rows"))
    )


@over_months
def store_performance(tables: Tables, months: Months = None) -> DataFrame:
    """Store by month. Grouped on the key alone; attributes join the result."""
    by_store = (
        sales_of(tables, months)
        .groupBy("sale_month", "store_id")
        .agg(
            total("revenue").alias("revenue"),
            total("total_cost").alias("total_cost"),
            total("profit").alias("profit"),
            F.sum("quantity").alias("quantity"),
            F.count(F.lit(1)).alias("sales_rows"),
            F.count_distinct("product_id").alias("active_products"),
        )
    )
    return with_store(by_store, tables, "store_area_sqm", "employees_count").select(
        "sale_month", "store_id", *STORE_NAMES, "store_area_sqm", "employees_count",
        "revenue", "total_cost", "profit", "quantity", "sales_rows", "active_products",
        pct("profit", "revenue").alias("margin_pct"),
        ratio("revenue", "employees_count").alias("revenue_per_employee"),
        ratio("revenue", "store_area_sqm").alias("revenue_per_sqm"),
    )


@over_months
def category_performance(tables: Tables, months: Months = None) -> DataFrame:
    """Category, subcategory, brand and supplier by month, with revenue share.

    Sales are read once and summed by product and store before anything is
    joined. The share's base comes from the same sums, joined back by month; a
    window per month would gather all of a month's rows in one task.
    """
    fine = (
        sales_of(tables, months)
        .groupBy("sale_month", "category", "product_id", "store_id")
        .agg(
            *(total(c).alias(c) for c in ("revenue", "total_cost", "profit")),
            F.sum("quantity").alias("quantity"),
            F.count(F.lit(1)).alias("sales_rows"),
        )
    )
    month_total = fine.groupBy("sale_month").agg(
        (F.sum("revenue") + F.sum(zero_of_all(fine))).cast(TOTAL).alias("month_revenue")
    )
    groups = (
        with_product(fine, tables, "subcategory", "brand", "supplier")
        .groupBy("sale_month", "category", "subcategory", "brand", "supplier")
        .agg(
            *(total(c).alias(c) for c in ("revenue", "total_cost", "profit")),
            F.sum("quantity").alias("quantity"),
            F.sum("sales_rows").alias("sales_rows"),
            F.count_distinct("store_id").alias("active_stores"),
        )
        .withColumn("margin_pct", pct("profit", "revenue"))
    )
    return (
        groups.join(month_total, "sale_month")
        .withColumn("revenue_share_pct", pct("revenue", "month_revenue"))
        .drop("month_revenue")
    )


def _sales_by(tables: Tables, months: Months, *keys: str) -> DataFrame:
    return (
        sales_of(tables, months)
        .groupBy(*keys)
        .agg(
            total("revenue").alias("revenue"),
            total("profit").alias("profit"),
            F.sum("quantity").alias("quantity"),
        )
    )


@over_months
def monthly_kpi(tables: Tables, months: Months = None) -> DataFrame:
    return (
        sales_of(tables, months)
        .groupBy("sale_month")
        .agg(
            total("revenue").alias("revenue"),
            total("profit").alias("profit"),
            F.sum("quantity").alias("quantity"),
            F.count(F.lit(1)).alias("sales_count"),
        )
    )


@over_months
def store_monthly(tables: Tables, months: Months = None) -> DataFrame:
    return _sales_by(tables, months, "sale_month", "store_id")


@over_months
def category_monthly(tables: Tables, months: Months = None) -> DataFrame:
    return _sales_by(tables, months, "sale_month", "category")
