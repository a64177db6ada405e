"""ABC by revenue and XYZ by steadiness of demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import abc
from ..functions.numbers import pct, total
from ..operators.running_total import running_total
from ..operators.selectors import over_months
from .sales import Months, Tables, sales_of, with_product


@over_months
def abc_xyz_analysis(tables: Tables, months: Months = None) -> DataFrame:
    """Classes per product (and sale category), over months that had sales.

    The spread of demand is compared as integers: with n months, sum S and sum
    of squares Q, the squared variation is (n*Q - S*S) / (S*S).
    """
    monthly = (
        sales_of(tables, months)
        .groupBy("sale_month", "product_id", "category")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.sum("quantity").alias("quantity"),
        )
    )
    units = F.col("quantity").cast("decimal(18,0)")
    products = monthly.groupBy("product_id", "category").agg(
        total("revenue").alias("revenue"),
        total("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
        F.sum(units * units).alias("squares"),
        F.count(F.lit(1)).alias("active_months"),
    )
    ranked = running_total(
        products, "revenue", [F.asc("product_id"), F.asc("category")],
        "revenue_so_far", "all_revenue",
    )
    shares = (
        ranked.withColumn("revenue_share_pct", pct("revenue", "all_revenue", 4))
        .withColumn("cumulative_revenue_share_pct", pct("revenue_so_far", "all_revenue", 4))
    )
    squared_sum = F.col("quantity").cast("decimal(18,0)") * F.col("quantity").cast("decimal(18,0)")
    spread = F.col("active_months").cast("decimal(10,0)") * F.col("squares") - squared_sum
    has_mean = F.col("quantity") != 0
    variation = F.sqrt(spread.cast("double")) / F.col("quantity").cast("double")
    hundredths = F.floor(variation * 10000 + F.lit(0.5)).cast("decimal(20,0)")
    classed = with_product(
        shares, tables, "product_name", "subcategory", "brand", "supplier"
    ).withColumns({
        "abc_class": abc("cumulative_revenue_share_pct"),
        "demand_cv_pct": F.when(has_mean, (hundredths / 100).cast("decimal(22,2)")),
        "xyz_class": F.when(has_mean & (spread * 100 <= squared_sum), "X")
        .when(has_mean & (spread * 16 <= squared_sum), "Y")
        .otherwise("Z"),
    })
    return classed.select(
        "product_id", "product_name", "category", "subcategory", "brand", "supplier",
        "revenue", "profit", "quantity", "active_months",
        pct("profit", "revenue").alias("margin_pct"),
        "revenue_share_pct", "cumulative_revenue_share_pct", "abc_class",
        "demand_cv_pct", "xyz_class",
        F.concat("abc_class", "xyz_class").alias("abc_xyz_class"),
    )
