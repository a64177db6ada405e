"""Exchange rates by month and what they do to cost and margin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..functions.labels import fx_risk
from ..functions.numbers import change_pct, exact_avg, or_zero, pct, ratio, total
from ..operators.selectors import (
    dated_in_months, dated_up_to_months, in_months, over_months, up_to_months,
)
from .sales import Months, Tables, sales_of


@over_months
def currency_rates_monthly(tables: Tables, months: Months = None) -> DataFrame:
    return _by_month(dated_in_months(tables["currency_rates"], "rate_date", months))


def _by_month(rates: DataFrame) -> DataFrame:
    rate = F.col("rate_to_rub")
    spread = (F.max(rate) - F.min(rate)) * F.count(rate)
    return (
        rates.groupBy(month_of("rate_date").alias("report_month"), "currency_code", "currency_name")
        .agg(
            exact_avg(rate, 4).alias("avg_rate_to_rub"),
            F.min(rate).alias("min_rate_to_rub"),
            F.max(rate).alias("max_rate_to_rub"),
            F.min_by(rate, "rate_date").alias("first_rate_to_rub"),
            F.max_by(rate, "rate_date").alias("last_rate_to_rub"),
            # spread over the unrounded mean, as one fraction
            pct(spread, F.sum(rate)).alias("monthly_volatility_pct"),
            F.count(F.lit(1)).alias("observations"),
        )
        .select(
            "report_month", "currency_code", "currency_name",
            "avg_rate_to_rub", "min_rate_to_rub", "max_rate_to_rub",
            "first_rate_to_rub", "last_rate_to_rub",
            change_pct("last_rate_to_rub", "first_rate_to_rub").alias("monthly_change_pct"),
            "monthly_volatility_pct", "observations",
        )
    )


@over_months
def sales_fx_monthly(tables: Tables, months: Months = None) -> DataFrame:
    """Month totals in every currency with rates that month.

    Month-over-month compares with the previous month present on both sides,
    so both sides are read up to the last of ``months``.
    """
    sales = (
        up_to_months(sales_of(tables), "sale_month", months)
        .groupBy(F.col("sale_month").alias("report_month"))
        .agg(
            total("revenue").alias("revenue_rub"),
            total("total_cost").alias("total_cost_rub"),
            total("profit").alias("profit_rub"),
            F.sum("quantity").alias("quantity"),
        )
        .withColumn("margin_pct", pct("profit_rub", "revenue_rub"))
    )
    rates = _by_month(dated_up_to_months(tables["currency_rates"], "rate_date", months)).select(
        "report_month", "currency_code", "currency_name",
        "avg_rate_to_rub", "monthly_change_pct", "monthly_volatility_pct",
    )
    previous = Window.partitionBy("currency_code").orderBy("report_month")
    joined = sales.join(rates, "report_month").withColumns({
        "rate_before": F.lag("avg_rate_to_rub").over(previous),
        "revenue_before": F.lag("revenue_rub").over(previous),
    })
    result = joined.select(
        "report_month", "currency_code", "currency_name",
        "revenue_rub", "total_cost_rub", "profit_rub", "quantity", "margin_pct",
        "avg_rate_to_rub", "monthly_change_pct", "monthly_volatility_pct",
        ratio("revenue_rub", "avg_rate_to_rub").alias("revenue_in_currency"),
        ratio("total_cost_rub", "avg_rate_to_rub").alias("total_cost_in_currency"),
        ratio("profit_rub", "avg_rate_to_rub").alias("profit_in_currency"),
        change_pct("avg_rate_to_rub", "rate_before").alias("avg_rate_mom_pct"),
        change_pct("revenue_rub", "revenue_before").alias("revenue_rub_mom_pct"),
    )
    return in_months(result, "report_month", months)


@over_months
def fx_risk_metrics(tables: Tables, months: Months = None) -> DataFrame:
    """Cost pressure of a rate move; no earlier month means no pressure."""
    mom = F.col("avg_rate_mom_pct")
    pressure = F.col("total_cost_rub") * or_zero(mom)
    return sales_fx_monthly(tables, months).select(
        "report_month", "currency_code", "currency_name",
        "revenue_rub", "total_cost_rub", "profit_rub", "margin_pct", "avg_rate_to_rub",
        "avg_rate_mom_pct",
        ratio(pressure, F.lit(100)).alias("estimated_cost_pressure_rub"),
        ratio(F.col("profit_rub") * 100 - pressure, "revenue_rub")
        .alias("margin_after_fx_pressure_pct"),
        fx_risk(mom).alias("fx_risk_status"),
    )
