"""The star schema as landing files would bring it: text, repeats and gaps.

The line key repeats and returned lines carry a negative quantity, so cleaning
has real duplicates and invalid rows to deal with. ``landing_position`` stands
in for the place of a row in its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..operators.cleaning import LANDING_ORDER
from ..schemas import ENTITIES, MONEY
from .star_schema import StarSchemaTables, product_id, store_id


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY).cast("string")


def _as_text(name: str, rows: DataFrame, position: list[str]) -> DataFrame:
    return rows.select(
        *(F.col(c).cast("string").alias(c) for c in ENTITIES[name].staged.names),
        F.struct(*position).alias(LANDING_ORDER),
    )


def landed_stores(tables: StarSchemaTables) -> DataFrame:
    """Areas and head counts of zero arrive empty."""
    rows = tables["stores"].withColumns({
        "store_area_sqm": F.nullif("store_area_sqm", F.lit(0)),
        "employees_count": F.nullif("employees_count", F.lit(0)),
    })
    return _as_text("stores", rows, ["store_id"])


def landed_products(tables: StarSchemaTables) -> DataFrame:
    """The activity flag arrives empty and is read as active."""
    rows = tables["products"].withColumn("is_active", F.lit("NA"))
    return _as_text("products", rows, ["product_id"])


_LINE = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
    "l_quantity", "l_discount", "l_returnflag",
]


def _lines(tables: StarSchemaTables) -> DataFrame:
    """Order lines as they lie: the line as landing position, and what isn't part of that."""
    parts = tables.source("part").select("p_partkey", F.col("p_type").alias("category"))
    return (
        tables.source("lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.struct(*_LINE).alias(LANDING_ORDER), "category", "l_linestatus")
    )


def _line(name: str) -> Column:
    return F.col(f"{LANDING_ORDER}.{name}")


def _day() -> Column:
    return _line("l_shipdate").cast("date")


def _amounts(rows: DataFrame) -> DataFrame:
    """What all tables derive from a line."""
    gross = _line("l_extendedprice").cast(MONEY)
    revenue = F.round(gross * (F.lit(1) - _line("l_discount").cast("decimal(5,2)")), 2)
    cost = F.round(gross * F.lit("0.72").cast("decimal(3,2)"), 2)
    units = _line("l_quantity").cast("int")
    return rows.withColumns({
        "day": _day(), "gross": gross, "revenue": revenue, "total_cost": cost,
        "profit": revenue - cost,
        "store_id": store_id(f"{LANDING_ORDER}.l_suppkey"),
        "product_id": product_id(f"{LANDING_ORDER}.l_partkey"),
        "quantity": F.when(_line("l_returnflag") == "R", -units).otherwise(units),
    })


def _line_text(name: str, rows: DataFrame) -> DataFrame:
    return rows.select(
        *(F.col(c).cast("string").alias(c) for c in ENTITIES[name].staged.names), LANDING_ORDER)


def sales_lines(tables: StarSchemaTables) -> DataFrame:
    order = _line("l_orderkey").cast("string")
    number = _line("l_linenumber").cast("string")
    return _lines(tables).withColumn("sale_id", F.concat_ws("-", order, number))


def sales_text(lines: DataFrame) -> DataFrame:
    rows = _amounts(lines).withColumns({
        "invoice_no": _line("l_orderkey").cast("string"), "invoice_type": F.col("l_linestatus"),
        "sale_datetime": F.concat(F.col("day").cast("string"), F.lit(" 12:30:00")),
        "sale_date": F.col("day"), "sale_month": month_of("day"),
        "stock_code": _line("l_partkey"), "description": F.lit(None),
        "unit_price": _line("l_extendedprice").cast("decimal(12,2)"),
        "discount_rate": F.when(_line("l_discount") == 0, "").otherwise(
            _line("l_discount").cast("decimal(5,2)").cast("string")),
        "unit_cost": F.col("total_cost"),
        "customer_id": F.lit("n/a"), "country": F.lit("NULL"),
        "sales_channel": _line("l_returnflag"),
    })
    return _line_text("sales", rows)


def inventory_lines(tables: StarSchemaTables) -> DataFrame:
    return _lines(tables).withColumns({
        "inventory_date": F.last_day(_day()).cast("string"),
        "store_id": store_id(f"{LANDING_ORDER}.l_suppkey"),
        "product_id": product_id(f"{LANDING_ORDER}.l_partkey"),
    })


def inventory_text(lines: DataFrame) -> DataFrame:
    qty = _line("l_quantity").cast("int") * 7 % 61
    rows = _amounts(lines).withColumns({
        "stock_qty": qty,
        "stock_value": _money("gross"), "reorder_point": F.lit("15.9"),
        "days_of_cover": F.when(qty == 0, "nan").otherwise(_line("l_quantity").cast("string")),
        "stock_status": F.when(qty < 15, "LOW").when(qty > 45, "OVERSTOCK").otherwise("OK"),
    })
    return _line_text("inventory", rows)


def plan_lines(tables: StarSchemaTables) -> DataFrame:
    return _lines(tables).withColumns({
        "plan_month": month_of(F.add_months(_day(), 12)),
        "store_id": store_id(f"{LANDING_ORDER}.l_suppkey"),
    })


def plan_text(lines: DataFrame) -> DataFrame:
    rows = _amounts(lines).withColumns({
        "plan_revenue": _money("revenue"), "plan_profit": _money("profit"),
        "plan_qty": F.when(F.col("quantity") < 0, "none").otherwise(
            F.col("quantity").cast("string")),
    })
    return _line_text("plan_sales", rows)


def landed_sales(tables: StarSchemaTables) -> DataFrame:
    return sales_text(sales_lines(tables))


def landed_inventory(tables: StarSchemaTables) -> DataFrame:
    return inventory_text(inventory_lines(tables))


def landed_plan(tables: StarSchemaTables) -> DataFrame:
    return plan_text(plan_lines(tables))


def landed_rates(tables: StarSchemaTables) -> DataFrame:
    code = F.substr("o_orderpriority", F.lit(3))
    rows = tables.source("orders").withColumns({
        "rate_date": F.col("o_orderdate").cast("date"), "currency_code": code,
        "currency_name": F.concat(F.lit("Currency "), code), "nominal": F.lit("None"),
        "rate_to_rub": F.col("o_totalprice").cast("decimal(12,2)"), "source_url": F.lit("feed"),
        "load_dttm": F.col("o_orderdate"),
    })
    return _as_text("currency_rates", rows, ["o_orderdate", "o_orderkey"])


LANDED = {
    "stores": landed_stores, "products": landed_products, "sales": landed_sales,
    "inventory": landed_inventory, "plan_sales": landed_plan, "currency_rates": landed_rates,
}
# keys and whole lines, and what gives kept ones their texts
FROM_LINES = {
    "sales": (sales_lines, sales_text), "inventory": (inventory_lines, inventory_text),
    "plan_sales": (plan_lines, plan_text),
}
