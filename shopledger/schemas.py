"""Tables of the retail model: types, keys and required columns.

One ``Entity`` describes a table through its three layers: landed text, the
typed staging table and the keyed core table the marts read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

CURRENCIES = ("USD", "EUR", "CNY")

MONEY = "decimal(14,2)"
PRICE = "decimal(12,2)"
RATE = "decimal(12,4)"


_SIMPLE = {
    "string": T.StringType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "int": T.IntegerType(), "smallint": T.ShortType(),
}


def ddl(text: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike ``fromDDL`` it needs no session."""
    fields = []
    for name, kind in (part.split() for part in text.split(", ")):
        if kind.startswith("decimal"):
            precision, scale = map(int, kind[len("decimal("):-1].split(","))
            fields.append(T.StructField(name, T.DecimalType(precision, scale)))
        else:
            fields.append(T.StructField(name, _SIMPLE[kind]))
    return T.StructType(fields)


@dataclass(frozen=True)
class Entity:
    name: str
    staged: T.StructType
    key: tuple[str, ...]
    not_null: tuple[str, ...]
    # rows lacking one of these are dropped while cleaning
    required: tuple[str, ...]
    # value given to unreadable or missing numbers while cleaning
    fill: dict[str, int] = field(default_factory=dict)
    core_columns: tuple[str, ...] = ()
    # column the core table is partitioned by, and how to compute it when the
    # table has no such column of its own
    partition: str | None = None
    partition_expr: str | None = None
    # whether rows of one key are always in the same partition
    partition_follows_key: bool = False
    keep: str = "first"

    @property
    def landed(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.staged])

    @property
    def core(self) -> T.StructType:
        names = self.core_columns or tuple(self.staged.names)
        return T.StructType([self.staged[n] for n in names])


SALES = Entity(
    name="sales",
    staged=ddl(
        "sale_id string, invoice_no string, invoice_type string, sale_datetime timestamp_ntz,"
        " sale_date date, sale_month string, store_id string, product_id string,"
        " stock_code string, description string, category string, quantity int,"
        f" unit_price {PRICE}, discount_rate decimal(5,2), revenue {MONEY},"
        f" unit_cost {PRICE}, total_cost {MONEY}, profit {MONEY},"
        " customer_id string, country string, sales_channel string"
    ),
    key=("sale_id",),
    not_null=(
        "sale_id", "invoice_no", "invoice_type", "sale_datetime", "sale_date", "sale_month",
        "store_id", "product_id", "category", "quantity", "unit_price", "discount_rate",
        "revenue", "unit_cost", "total_cost", "profit",
    ),
    required=(
        "sale_id", "invoice_no", "sale_datetime", "sale_date", "store_id", "product_id", "category",
    ),
    fill={"discount_rate": 0},
    core_columns=(
        "sale_id", "sale_date", "sale_month", "store_id", "product_id", "category", "quantity",
        "revenue", "total_cost", "profit", "sales_channel",
    ),
    partition="sale_month",
)

STORES = Entity(
    name="stores",
    staged=ddl(
        "store_id string, store_name string, city string, region string, format string,"
        " opening_date date, store_area_sqm int, employees_count int"
    ),
    key=("store_id",),
    not_null=(
        "store_id", "store_name", "city", "region", "format", "opening_date",
        "store_area_sqm", "employees_count",
    ),
    required=("store_id", "store_name", "city", "region", "format", "opening_date"),
    fill={"store_area_sqm": 0, "employees_count": 0},
)

PRODUCTS = Entity(
    name="products",
    staged=ddl(
        "product_id string, stock_code string, product_name string, category string,"
        f" subcategory string, brand string, supplier string, unit_cost {PRICE},"
        f" unit_price {PRICE}, uom string, is_active smallint"
    ),
    key=("product_id",),
    not_null=("product_id", "product_name", "category", "unit_cost", "unit_price", "is_active"),
    required=("product_id", "product_name", "category"),
    fill={"unit_cost": 0, "unit_price": 0, "is_active": 1},
)

INVENTORY = Entity(
    name="inventory",
    staged=ddl(
        "inventory_date date, store_id string, product_id string, stock_qty int,"
        f" stock_value {MONEY}, reorder_point int, days_of_cover decimal(10,2), stock_status string"
    ),
    key=("inventory_date", "store_id", "product_id"),
    not_null=(
        "inventory_date", "store_id", "product_id", "stock_qty", "stock_value",
        "reorder_point", "days_of_cover", "stock_status",
    ),
    required=("inventory_date", "store_id", "product_id", "stock_status"),
    fill={"stock_qty": 0, "reorder_point": 0, "stock_value": 0, "days_of_cover": 0},
    partition="inventory_month",
    partition_expr="date_format(inventory_date, 'yyyy-MM')",
    partition_follows_key=True,
)

PLAN_SALES = Entity(
    name="plan_sales",
    staged=ddl(
        f"plan_month string, store_id string, category string, plan_revenue {MONEY},"
        f" plan_profit {MONEY}, plan_qty int"
    ),
    key=("plan_month", "store_id", "category"),
    not_null=("plan_month", "store_id", "category", "plan_revenue", "plan_profit", "plan_qty"),
    required=("plan_month", "store_id", "category"),
    fill={"plan_revenue": 0, "plan_profit": 0, "plan_qty": 0},
    partition="plan_month",
    partition_follows_key=True,
)

CURRENCY_RATES = Entity(
    name="currency_rates",
    staged=ddl(
        "rate_date date, currency_code string, currency_name string, nominal int,"
        f" rate_to_rub {RATE}, source_url string"
    ),
    key=("rate_date", "currency_code"),
    not_null=("rate_date", "currency_code", "currency_name", "nominal", "rate_to_rub"),
    required=("rate_date", "currency_code", "currency_name", "rate_to_rub"),
    fill={"nominal": 1},
    keep="last",
)

ENTITIES = {e.name: e for e in (STORES, PRODUCTS, SALES, INVENTORY, PLAN_SALES, CURRENCY_RATES)}

# the five tables that land as CSV, dimensions first
CSV_ENTITIES = ("stores", "products", "sales", "inventory", "plan_sales")
