"""Queries behind dashboard widgets.

Every widget takes ``selectors``, a mapping of column to chosen values. Chosen
months reach the scans. Chosen stores and products cut the facts by a semi join
on their ids before anything is summed. Facts are summed on their own columns
and dimension keys first; a dimension is joined to that small result, and only
if a group asks for one of its attributes.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import fx_risk
from ..functions.numbers import TOTAL, or_zero, pct, ratio, total
from ..operators.selectors import apply_selectors, checked_values
from .fx import sales_fx_monthly
from .inventory import inventory_of, inventory_risks
from .kpi_mart import dashboard_summary
from .plan_fact import cells, plan_fact_dashboard, planned
from .sales import STORE_NAMES, Tables, sales_of, store_attributes, store_performance

Selectors = Mapping[str, Iterable] | None

_PRODUCT = ("product_name", "category", "subcategory", "brand", "supplier")


def widget(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A widget whose chosen values may be any iterables: they are read once, here."""

    @wraps(query)
    def run(tables: Tables, selectors: Selectors = None) -> DataFrame:
        return query(tables, {c: checked_values(v) for c, v in (selectors or {}).items()})

    return run


def _of_chosen(facts: DataFrame, tables: Tables, selectors: Mapping[str, tuple]) -> DataFrame:
    """Facts of the chosen stores and products, cut by their ids."""
    for dimension, key, names in (
        (store_attributes(tables), "store_id", STORE_NAMES), (tables["products"], "product_id", _PRODUCT),
    ):
        chosen = {
            c: selectors[c] for c in names if selectors.get(c) and c not in facts.columns
        }
        if chosen and key in facts.columns:
            ids = apply_selectors(dimension, chosen).select(key)
            facts = facts.join(ids, key, "left_semi")
    return facts


def _narrowed(tables: Tables, selectors: Mapping[str, tuple]) -> Tables:
    facts = ("sales", "plan_sales", "inventory")
    return ChainMap({n: _of_chosen(tables[n], tables, selectors) for n in facts}, tables)


def _months(selectors: Mapping[str, tuple], column: str = "sale_month") -> tuple | None:
    return selectors.get(column) or None


def summed(
    facts: DataFrame, tables: Tables, group: Sequence[str], sums: Sequence[str],
    selectors: Selectors = None,
) -> DataFrame:
    """Totals of ``sums`` by ``group`` for the selected rows."""
    selectors = dict(selectors or {})
    own = [c for c in facts.columns if c in {*group, *selectors}]
    unknown = {*group, *selectors} - {*own, *STORE_NAMES, *_PRODUCT}
    facts = apply_selectors(facts, {c: v for c, v in selectors.items() if c in own})
    facts = _of_chosen(facts, tables, selectors)
    from_store = [c for c in STORE_NAMES if c in group and c not in own]
    from_product = [c for c in _PRODUCT if c in group and c not in own]
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")

    keys = [c for c in own if c in group]
    if from_store and "store_id" not in keys:
        keys.append("store_id")
    if from_product and "product_id" not in keys:
        keys.append("product_id")
    rows = facts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))
    if not (from_store or from_product):
        return rows
    if from_store:
        rows = rows.join(store_attributes(tables).select("store_id", *from_store), "store_id", "left")
    if from_product:
        rows = rows.join(
            tables["products"].select("product_id", *from_product), "product_id", "left"
        )
    return rows.groupBy(*group).agg(*(F.sum(c).alias(c) for c in sums))


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(TOTAL) for c in columns})


@widget
def executive_summary(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return apply_selectors(dashboard_summary(tables, _months(selectors)), selectors).select(
        "sale_month", "revenue", "profit", "margin_pct", "revenue_plan_completion_pct"
    )


def _sales_widget(tables, group, measure, selectors):
    return _money(summed(sales_of(tables), tables, [group], [measure], selectors), measure)


@widget
def revenue_by_day(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _sales_widget(tables, "sale_date", "revenue", selectors)


@widget
def revenue_by_category(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _sales_widget(tables, "category", "revenue", selectors)


@widget
def profit_by_brand(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _sales_widget(tables, "brand", "profit", selectors)


@widget
def revenue_by_channel(tables: Tables, selectors: Selectors = None) -> DataFrame:
    """Revenue of each sales channel and its share of the selected total."""
    channels = _sales_widget(tables, "sales_channel", "revenue", selectors)
    everything = channels.agg(total("revenue")).scalar()
    return channels.withColumn("all_revenue", everything).select(
        "sales_channel", "revenue", pct("revenue", "all_revenue").alias("revenue_share_pct")
    )


@widget
def sales_table(tables: Tables, selectors: Selectors = None) -> DataFrame:
    group = ["store_name", "product_name", "category"]
    rows = summed(sales_of(tables), tables, group, ["revenue", "profit"], selectors)
    return _money(rows, "revenue", "profit").withColumn("margin_pct", pct("profit", "revenue"))


@widget
def store_table(tables: Tables, selectors: Selectors = None) -> DataFrame:
    rows = store_performance(_narrowed(tables, selectors), _months(selectors))
    return apply_selectors(rows, selectors).select(
        "sale_month", "store_name", "city", "region", "revenue", "profit", "margin_pct",
        "revenue_per_employee", "revenue_per_sqm",
    )


@widget
def revenue_by_store(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _sales_widget(tables, "store_name", "revenue", selectors)


@widget
def profit_by_store(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _sales_widget(tables, "store_name", "profit", selectors)


def _revenue_per(tables: Tables, attribute: str, name: str, selectors: Selectors) -> DataFrame:
    """Selected revenue of the stores of a name over the sum of their attribute."""
    by_store = summed(sales_of(tables), tables, ["store_id"], ["revenue"], selectors)
    named = by_store.join(store_attributes(tables, attribute), "store_id", "left")
    return named.groupBy("store_name").agg(ratio(total("revenue"), F.sum(attribute)).alias(name))


@widget
def revenue_per_employee_by_store(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _revenue_per(tables, "employees_count", "revenue_per_employee", selectors)


@widget
def revenue_per_sqm_by_store(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _revenue_per(tables, "store_area_sqm", "revenue_per_sqm", selectors)


@widget
def plan_fact_kpis(tables: Tables, selectors: Selectors = None) -> DataFrame:
    """Plan, fact and completion over everything selected, in one row."""
    rows = _plan_widget(tables, [], selectors)
    return rows.withColumn("revenue_plan_completion_pct", pct("fact_revenue", "plan_revenue"))


def _plan_widget(tables: Tables, group: Sequence[str], selectors: Selectors) -> DataFrame:
    weighted = planned(cells(_narrowed(tables, selectors), _months(selectors, "plan_month")))
    measures = ["plan_revenue", "fact_revenue"]
    return _money(summed(weighted, tables, group, measures, selectors), *measures)


@widget
def plan_fact_by_category_widget(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return _plan_widget(tables, ["category"], selectors)


@widget
def variance_by_store(tables: Tables, selectors: Selectors = None) -> DataFrame:
    rows = _plan_widget(tables, ["store_name"], selectors)
    gap = (F.col("fact_revenue") - F.col("plan_revenue")).cast(TOTAL)
    return rows.select("store_name", gap.alias("revenue_variance"))


@widget
def plan_fact_table(tables: Tables, selectors: Selectors = None) -> DataFrame:
    rows = plan_fact_dashboard(_narrowed(tables, selectors), _months(selectors, "plan_month"))
    return apply_selectors(rows, selectors).select(
        "plan_month", "store_name", "category", "plan_revenue", "fact_revenue",
        "revenue_variance", "revenue_plan_completion_pct",
    )


@widget
def stock_value_by_category(tables: Tables, selectors: Selectors = None) -> DataFrame:
    rows = summed(inventory_of(tables), tables, ["category"], ["stock_value"], selectors)
    return _money(rows, "stock_value")


@widget
def stock_status_by_region(tables: Tables, selectors: Selectors = None) -> DataFrame:
    positions = inventory_of(tables).withColumn("positions", F.lit(1))
    return summed(positions, tables, ["region", "stock_status"], ["positions"], selectors)


@widget
def inventory_kpis(tables: Tables, selectors: Selectors = None) -> DataFrame:
    """Stock value and the number of short and excess positions, per count date."""
    status = F.col("stock_status")
    flagged = inventory_of(tables).withColumns({
        "low_stock_positions": (status == "LOW").cast("int"),
        "overstock_positions": (status == "OVERSTOCK").cast("int"),
    })
    sums = ["stock_value", "low_stock_positions", "overstock_positions"]
    return _money(summed(flagged, tables, ["inventory_date"], sums, selectors), "stock_value")


@widget
def inventory_table(tables: Tables, selectors: Selectors = None) -> DataFrame:
    return apply_selectors(inventory_risks(_narrowed(tables, selectors)), selectors).select(
        "inventory_date", "store_name", "product_name", "category", "stock_qty",
        "reorder_point", "days_of_cover", "stock_status",
    )


@widget
def fx_page(tables: Tables, selectors: Selectors = None) -> DataFrame:
    """Rates, sales in currency, cost pressure and risk side by side."""
    mom = F.col("avg_rate_mom_pct")
    rows = apply_selectors(sales_fx_monthly(tables, _months(selectors, "report_month")), selectors)
    return rows.select(
        "report_month", "currency_code", "avg_rate_to_rub", "avg_rate_mom_pct",
        "revenue_in_currency", "profit_in_currency",
        ratio(F.col("total_cost_rub") * or_zero(mom), F.lit(100))
        .alias("estimated_cost_pressure_rub"),
        fx_risk(mom).alias("fx_risk_status"),
    )
