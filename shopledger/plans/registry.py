"""All marts by name, and their registration as temporary views."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from . import fx, inventory, kpi_mart, plan_fact, product_classes, sales
from .sales import Months, Tables

MARTS: dict[str, Callable[..., DataFrame]] = {
    "sales_enriched": sales.sales_enriched,
    "monthly_sales_kpi": sales.monthly_sales_kpi,
    "currency_rates_monthly": fx.currency_rates_monthly,
    "sales_fx_monthly": fx.sales_fx_monthly,
    "fx_risk_metrics": fx.fx_risk_metrics,
    "store_performance": sales.store_performance,
    "category_performance": sales.category_performance,
    "category_plan_fact": plan_fact.category_plan_fact,
    "plan_fact_dashboard": plan_fact.plan_fact_dashboard,
    "inventory_risks": inventory.inventory_risks,
    "dashboard_summary": kpi_mart.dashboard_summary,
    "plan_fact_trend": plan_fact.plan_fact_trend,
    "retail_kpi_mart": kpi_mart.retail_kpi_mart,
    "store_monthly_heatmap": kpi_mart.store_monthly_heatmap,
    "abc_xyz_analysis": product_classes.abc_xyz_analysis,
    "inventory_turnover": inventory.inventory_turnover,
    "monthly_kpi": sales.monthly_kpi,
    "store_monthly": sales.store_monthly,
    "category_monthly": sales.category_monthly,
    "plan_fact_summary": plan_fact.plan_fact_summary,
    "plan_fact_store": plan_fact.plan_fact_store,
    "plan_fact_category": plan_fact.plan_fact_category,
    "inventory_summary": inventory.inventory_summary,
    "inventory_alerts": inventory.inventory_alerts,
}


def register_all(
    tables: Tables, months: Months = None, prefix: str = "", marts: Iterable[str] = tuple(MARTS)
) -> list[str]:
    """Make core tables and marts queryable from ``spark.sql``; views are computed when queried."""
    for name, table in tables.items():
        table.createOrReplaceTempView(prefix + name)
    for name in marts:
        MARTS[name](tables, months).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in (*tables, *marts)]
