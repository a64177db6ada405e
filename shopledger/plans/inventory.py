"""Stock marts: positions at risk, totals by date, turnover by product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..functions.labels import turnover
from ..functions.numbers import exact_avg, or_zero, ratio, total
from ..operators.selectors import dated_in_months, in_months, over_months
from .sales import STORE_NAMES, Months, Tables, sales_of, with_product, with_store


def inventory_of(tables: Tables, months: Months = None) -> DataFrame:
    """Stock positions; also prunes by month where the table is partitioned so."""
    rows = dated_in_months(tables["inventory"], "inventory_date", months)
    if "inventory_month" in rows.columns:
        rows = in_months(rows, "inventory_month", months).drop("inventory_month")
    return rows


@over_months
def inventory_risks(tables: Tables, months: Months = None) -> DataFrame:
    rows = with_store(inventory_of(tables, months), tables)
    rows = with_product(
        rows, tables, "product_name", "category", "subcategory", "brand", "supplier"
    )
    status = F.col("stock_status")
    return rows.select(
        "inventory_date", "store_id", *STORE_NAMES,
        "product_id", "product_name", "category", "subcategory", "brand", "supplier",
        "stock_qty", "stock_value", "reorder_point", "days_of_cover", "stock_status",
        F.when(status == "LOW", 1).otherwise(0).alias("is_low_stock"),
        F.when(status == "OVERSTOCK", 1).otherwise(0).alias("is_overstock"),
        (F.col("stock_qty") - F.col("reorder_point")).alias("stock_vs_reorder_qty"),
    )


@over_months
def inventory_summary(tables: Tables, months: Months = None) -> DataFrame:
    return (
        inventory_of(tables, months)
        .groupBy("inventory_date")
        .agg(
            F.sum("stock_qty").alias("total_stock_qty"),
            total("stock_value").alias("total_stock_value"),
        )
    )


@over_months
def inventory_alerts(tables: Tables, months: Months = None) -> DataFrame:
    """All positions in alert layout; the name promises a filter it never had."""
    return inventory_of(tables, months).select(
        "inventory_date", "store_id", "product_id", "stock_qty", "stock_value",
        "reorder_point", "days_of_cover", "stock_status",
    )


@over_months
def inventory_turnover(
    tables: Tables, months: Months = None, exact_quantity_ratio: bool = False
) -> DataFrame:
    """Sales against stock per month, store and product.

    Sold over stocked units is an integer division in the contract; pass
    ``exact_quantity_ratio`` for the fraction. Names join the aligned result,
    so each dimension is read once and never meets the fact rows.
    """
    key = ["report_month", "store_id", "product_id"]
    sold = (
        sales_of(tables, months)
        .groupBy(F.col("sale_month").alias("report_month"), "store_id", "product_id",
                 F.col("category").alias("sale_category"))
        .agg(
            F.sum("quantity").alias("sold_qty"),
            total("revenue").alias("revenue"),
            total("profit").alias("profit"),
        )
    )
    # a position has at most 31 counts in a month, so summing them before the shuffle only costs;
    # the sort by which its texts are compared is the one that the join wants
    stocked = (
        inventory_of(tables, months)
        .withColumn("report_month", month_of("inventory_date"))
        .repartition(*key)
        .groupBy(*key)
        .agg(
            F.sum("stock_qty").alias("stock_qty"),
            total("stock_value").alias("stock_value"),
            exact_avg("days_of_cover", 8).alias("cover"),
            F.max("stock_status").alias("stock_status"),
        )
    )
    both = sold.join(stocked, key, "full")
    both = with_store(both, tables)
    both = with_product(both, tables, "product_name", "brand",
                        F.col("category").alias("product_category"))
    units = or_zero("sold_qty")
    stock = F.nullif("stock_qty", F.lit(0))
    if exact_quantity_ratio:
        quantity_ratio = ratio(units, "stock_qty", 4)
    else:
        quantity_ratio = F.call_function("div", units, stock).cast("decimal(22,4)")
    # a sale's own category wins; only rows without sales take the product's
    category = F.when(F.col("sold_qty").isNotNull(), F.col("sale_category"))
    return both.select(
        "report_month", "store_id", "store_name", "region", "product_id", "product_name",
        F.coalesce(category, "product_category").alias("category"),
        "brand",
        units.alias("sold_qty"),
        or_zero("revenue").alias("revenue"),
        or_zero("profit").alias("profit"),
        or_zero("stock_qty").alias("stock_qty"),
        or_zero("stock_value").alias("stock_value"),
        F.round(or_zero("cover"), 2).alias("avg_days_of_cover"),
        "stock_status",
        quantity_ratio.alias("qty_turnover_ratio"),
        ratio(or_zero("revenue"), "stock_value", 4).alias("value_turnover_ratio"),
        turnover(F.col("sold_qty"), F.col("stock_qty"), F.col("cover")).alias("turnover_status"),
    )
