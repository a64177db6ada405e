import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopledger.schemas import ENTITIES  # noqa: E402
from shopledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "sales": dict(
        sale_date=date(2024, 12, 2), store_id="S1", product_id="P1", category="Tea", quantity=1,
        revenue="20", total_cost="12", profit="8", sales_channel="online",
    ),
    "stores": dict(
        store_id="S1", store_name="One", city="Tver", region="Central", format="Convenience",
        opening_date=date(2020, 1, 1), store_area_sqm=100, employees_count=10,
    ),
    "products": dict(
        product_id="P1", stock_code="1", product_name="Tea 1", category="Tea", subcategory="Green",
        brand="Daily", supplier="V1", unit_cost="1", unit_price="2", uom="pcs", is_active=1,
    ),
    "plan_sales": dict(
        plan_month="2024-12", store_id="S1", category="Tea", plan_revenue="100",
        plan_profit="50", plan_qty=10,
    ),
    "inventory": dict(
        inventory_date=date(2024, 12, 31), store_id="S1", product_id="P1", stock_qty=20,
        stock_value="200", reorder_point=15, days_of_cover="30", stock_status="OK",
    ),
    "currency_rates": dict(
        rate_date=date(2024, 12, 1), currency_code="USD", currency_name="US dollar", nominal=1,
        rate_to_rub="100", source_url=None,
    ),
}


@pytest.fixture(scope="session")
def make(spark):
    """Core tables from partial rows: make(sales=[{...}], stores=[{...}], ...)."""

    def rows_of(name, rows):
        entity = ENTITIES[name]
        full = []
        for number, row in enumerate(rows):
            row = DEFAULTS[name] | row
            if name == "sales":
                row.setdefault("sale_id", f"T{number}")
                row.setdefault("sale_month", row["sale_date"].isoformat()[:7])
            full.append(tuple(
                Decimal(str(row[f.name])) if f.dataType.typeName() == "decimal"
                and row[f.name] is not None else row[f.name]
                for f in entity.core
            ))
        return spark.createDataFrame(full, entity.core)

    def build(**given):
        tables = {"stores": [{}], "products": [{}], "sales": [], "plan_sales": [],
                  "inventory": [], "currency_rates": []} | given
        return {name: rows_of(name, rows) for name, rows in tables.items()}

    return build


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


@pytest.fixture(scope="session")
def rows():
    """Result rows as dictionaries, decimals as floats, sorted by given columns."""

    def collect(df, *order):
        df = df.orderBy(*order) if order else df
        return [{k: plain(v) for k, v in r.asDict(recursive=True).items()} for r in df.collect()]

    return collect


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate column expressions over one row of the given fields."""

    def evaluate(expression, schema="x string", *fields):
        frame = spark.createDataFrame([fields or (None,)], schema)
        return plain(frame.select(expression.alias("v")).first().v)

    return evaluate


@pytest.fixture
def text_rows(spark):
    """Landed rows: dictionaries of text in file order."""

    def build(name, rows):
        entity = ENTITIES[name]
        data = [
            (*(row.get(c) for c in entity.staged.names), n) for n, row in enumerate(rows)
        ]
        columns = ", ".join(f"{c} string" for c in entity.staged.names)
        return spark.createDataFrame(data, f"{columns}, landing_position int")

    return build
