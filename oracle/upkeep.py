"""Cleaning, referential integrity, quality and merges."""

from __future__ import annotations

from .base import real, statement, text, whole

_POSITION = """l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount,
    l_returnflag"""
_LINE = f"""
    SELECT *, CAST(l_shipdate AS DATE) AS day, p_type AS category,
        'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS store_id,
        'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS product_id,
        CAST(l_extendedprice AS DECIMAL(14,2)) AS gross,
        CAST(round(gross * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(14,2)) AS revenue,
        CAST(round(gross * 0.72, 2) AS DECIMAL(14,2)) AS total_cost,
        CAST(l_quantity AS INTEGER) AS units
    FROM lineitem JOIN part ON p_partkey = l_partkey"""


def _first(key: str) -> str:
    return f"""SELECT * FROM line QUALIFY row_number() OVER (
        PARTITION BY {key} ORDER BY l_orderkey, l_linenumber, {_POSITION}) = 1"""


_STORE_ROW = f"""store_id, store_name, city, region, format, {text('opening_date')} AS opening_date,
    {whole('store_area_sqm')} AS store_area_sqm"""
_PRODUCT_ROW = f"""product_id, stock_code, product_name, category, subcategory, brand, supplier,
    {real('unit_cost')} AS unit_cost"""
_SALE_ROW = f"""sale_id, {text('sale_date')} AS sale_date, sale_month, store_id, product_id,
    category, {whole('quantity')} AS quantity"""
_SALE_REST = f"{real('total_cost')} AS total_cost, {real('profit')} AS profit"
_STOCK_ROW = f"{text('inventory_date')} AS inventory_date, store_id, product_id"
_STOCK_REST = f"""{real('stock_value')} AS stock_value, {whole('reorder_point')} AS reorder_point,
    {real('days_of_cover')} AS days_of_cover, stock_status"""
_PLAN_ROW = f"""plan_month, store_id, category, {real('plan_revenue')} AS plan_revenue,
    {real('plan_profit')} AS plan_profit"""


def _merged(table: str, row: str, key: str, old: str, new: str, before: str, after: str,
            needs: str | None = None) -> str:
    """Rows of the older load whose key the newer load lacks, then the newer load."""
    return statement(needs or table, f"""
        SELECT {row}, {before} FROM {table} WHERE {old}
            AND ({key}) NOT IN (SELECT ({key}) FROM {table} WHERE {new})
        UNION ALL SELECT {row}, {after} FROM {table} WHERE {new}""")


def _voted(value: str, formats: dict[str, str]) -> str:
    """The format that reads most values, the first of equally good ones."""
    counts = {name: f"count(try_strptime({value}, '{f}'))" for name, f in formats.items()}
    best = f"greatest({', '.join(counts.values())})"
    return "CASE " + " ".join(f"WHEN {n} = {best} THEN '{name}'" for name, n in counts.items()) + " END"


SQL = {
    "clean_stores": statement("stores", f"""
        SELECT {_STORE_ROW}, {whole('employees_count')} AS employees_count FROM stores"""),
    "clean_products": statement("products", f"""
        SELECT {_PRODUCT_ROW}, {real('unit_price')} AS unit_price, uom, {whole('1')} AS is_active
        FROM products"""),
    "clean_sales": statement("", f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sale_id,
            CAST(l_orderkey AS VARCHAR) AS invoice_no, l_linestatus AS invoice_type,
            CAST(day AS VARCHAR) || ' 12:30:00' AS sale_datetime, {text('day')} AS sale_date,
            strftime(day, '%Y-%m') AS sale_month, store_id, product_id,
            CAST(l_partkey AS VARCHAR) AS stock_code, CAST(NULL AS VARCHAR) AS description,
            category, {whole('units')} AS quantity, {real('gross')} AS unit_price,
            {real('CAST(l_discount AS DECIMAL(5,2))')} AS discount_rate,
            {real('revenue')} AS revenue, {real('total_cost')} AS unit_cost,
            {real('total_cost')} AS total_cost, {real('revenue - total_cost')} AS profit,
            CAST(NULL AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS country,
            l_returnflag AS sales_channel
        FROM ({_first('l_orderkey, l_linenumber')}) WHERE l_returnflag <> 'R' AND units > 0""",
        line=_LINE),
    "clean_inventory": statement("", f"""
        SELECT {text('last_day(day)')} AS inventory_date, store_id, product_id,
            {whole('units * 7 % 61')} AS stock_qty, {real('gross')} AS stock_value,
            {whole('15')} AS reorder_point,
            CASE WHEN units * 7 % 61 = 0 THEN 0 ELSE l_quantity END AS days_of_cover,
            CASE WHEN units * 7 % 61 < 15 THEN 'LOW' WHEN units * 7 % 61 > 45 THEN 'OVERSTOCK'
                 ELSE 'OK' END AS stock_status
        FROM ({_first('last_day(day), store_id, product_id')})""", line=_LINE),
    "clean_plan": statement("", f"""
        SELECT strftime(day + INTERVAL 1 YEAR, '%Y-%m') AS plan_month, store_id, category,
            {real('revenue')} AS plan_revenue, {real('revenue - total_cost')} AS plan_profit,
            {whole("CASE WHEN l_returnflag = 'R' THEN 0 ELSE units END")} AS plan_qty
        FROM ({_first("strftime(day, '%Y-%m'), store_id, category")})""", line=_LINE),
    "clean_rates": statement("", f"""
        SELECT {text('CAST(o_orderdate AS DATE)')} AS rate_date,
            substr(o_orderpriority, 3) AS currency_code,
            'Currency ' || substr(o_orderpriority, 3) AS currency_name, {whole('1')} AS nominal,
            {real('CAST(o_totalprice AS DECIMAL(12,2))')} AS rate_to_rub, 'feed' AS source_url
        FROM last_of_day""",
        last_of_day="""SELECT * FROM orders QUALIFY row_number() OVER (
            PARTITION BY CAST(o_orderdate AS DATE), o_orderpriority
            ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""),
    "ri_sales": statement("sales stores products", f"""
        SELECT {_SALE_ROW}, {real('revenue')} AS revenue, {_SALE_REST}, sales_channel FROM sales
        WHERE store_id IN (SELECT store_id FROM stores WHERE employees_count > 0)
          AND product_id IN (SELECT product_id FROM products WHERE unit_price >= 910)"""),
    "ri_inventory": statement("inventory stores products", f"""
        SELECT {_STOCK_ROW}, {whole('stock_qty')} AS stock_qty, {_STOCK_REST} FROM inventory
        WHERE store_id IN (SELECT store_id FROM stores WHERE employees_count > 0)
          AND product_id IN (SELECT product_id FROM products WHERE unit_price >= 910)"""),
    "ri_plan": statement("plan_sales stores", f"""
        SELECT {_PLAN_ROW}, {whole('plan_qty')} AS plan_qty FROM plan_sales
        WHERE store_id IN (SELECT store_id FROM stores WHERE employees_count > 0)"""),
    "quality_check": """
        SELECT * FROM (
            SELECT 'sales' AS table_name, 'not_null' AS rule, 'discount_rate' AS columns,
                count(*) AS bad_rows FROM lineitem WHERE l_discount = 0
            UNION ALL
            SELECT 'sales', 'not_null', 'quantity', count(*) FROM lineitem
            WHERE l_returnflag = 'R' OR l_quantity < 1
            UNION ALL
            SELECT 'sales', 'unique', 'sale_id', CAST(sum(n) AS BIGINT)
            FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1
        ) WHERE bad_rows > 0""",
    "clean_sales_of_mixed_dates": statement("", f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sale_id,
            CAST(l_orderkey AS VARCHAR) AS invoice_no, l_linestatus AS invoice_type,
            CAST(day AS VARCHAR) || ' 12:30:00' AS sale_datetime, {text('day')} AS sale_date,
            strftime(day, '%Y-%m') AS sale_month, store_id, product_id,
            CAST(l_partkey AS VARCHAR) AS stock_code, CAST(NULL AS VARCHAR) AS description,
            category, {whole('units')} AS quantity, {real('gross')} AS unit_price,
            {real('CAST(l_discount AS DECIMAL(5,2))')} AS discount_rate,
            {real('revenue')} AS revenue, {real('total_cost')} AS unit_cost,
            {real('total_cost')} AS total_cost, {real('revenue - total_cost')} AS profit,
            CAST(NULL AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS country,
            l_returnflag AS sales_channel
        FROM ({_first('l_orderkey, l_linenumber')})
        WHERE l_returnflag <> 'R' AND units > 0 AND l_orderkey % 10 <> 7""", line=_LINE),
    "date_formats": statement("", f"""
        SELECT 'sales' AS table_name, 'sale_datetime' AS column_name, {_voted(
            "strftime(day, '%-d.%-m.%Y')", {"d.M.yyyy": "%d.%m.%Y", "M.d.yyyy": "%m.%d.%Y"}
        )} AS style FROM line
        UNION ALL
        SELECT 'sales', 'sale_date', {_voted(
            "strftime(day, '%m-%d-%Y')", {"d-M-yyyy": "%d-%m-%Y", "M-d-yyyy": "%m-%d-%Y"}
        )} FROM line
        UNION ALL
        SELECT 'currency_rates', 'rate_date', {_voted(
            "strftime(CAST(o_orderdate AS DATE), '%Y%m%d')", {"yyyyMMdd": "%Y%m%d"}
        )} FROM orders""", line=_LINE),
    "quality_check_of_numbers": statement("", f"""
        SELECT 'sales' AS table_name, rule, columns, bad_rows FROM (
            SELECT count(*) FILTER (WHERE units % 10 = 1) AS no_type,
                count(*) FILTER (WHERE units % 10 = 7) AS wide_discount,
                count(*) FILTER (WHERE l_returnflag = 'A' AND trunc(revenue) >= 1000) AS wide_revenue
            FROM ({_first('l_orderkey, l_linenumber')}) WHERE l_returnflag <> 'R' AND units > 0
        ), LATERAL (VALUES ('not_null', 'invoice_type', no_type),
            ('precision', 'discount_rate', wide_discount),
            ('precision', 'revenue', wide_revenue)) AS v(rule, columns, bad_rows)
        WHERE bad_rows > 0""", line=_LINE),
    "upsert_sales": _merged(
        "sales", _SALE_ROW, "sale_id", "sale_date < DATE '2000-01-01'",
        "sale_date >= DATE '1999-01-01'",
        f"{real('revenue')} AS revenue, {_SALE_REST}, sales_channel",
        f"{real('revenue + 1')} AS revenue, {_SALE_REST}, sales_channel"),
    "upsert_stores": _merged(
        "stores", _STORE_ROW, "store_id", "store_area_sqm < 1200", "store_area_sqm >= 800",
        f"{whole('employees_count')} AS employees_count",
        f"{whole('employees_count + 5')} AS employees_count"),
    "upsert_products": _merged(
        "products", _PRODUCT_ROW, "product_id", "unit_price < 1000", "unit_price >= 950",
        f"{real('unit_price')} AS unit_price, uom, {whole('is_active')} AS is_active",
        f"{real('unit_price + 1')} AS unit_price, uom, {whole('is_active')} AS is_active"),
    "upsert_inventory": _merged(
        "inventory", _STOCK_ROW, "inventory_date, store_id, product_id",
        "inventory_date < DATE '2000-01-01'", "inventory_date >= DATE '1999-01-01'",
        f"{whole('stock_qty')} AS stock_qty, {_STOCK_REST}",
        f"{whole('stock_qty + 1')} AS stock_qty, {_STOCK_REST}"),
    "upsert_plan": _merged(
        "plan_sales", _PLAN_ROW, "plan_month, store_id, category", "plan_month < '2001-01'",
        "plan_month >= '2000-01'", f"{whole('plan_qty')} AS plan_qty",
        f"{whole('plan_qty + 1')} AS plan_qty"),
    "upsert_rates": _merged(
        "currency_rates",
        f"{text('rate_date')} AS rate_date, currency_code, currency_name, {whole('1')} AS nominal",
        "rate_date, currency_code", "rate_date < DATE '2000-01-01'",
        "rate_date >= DATE '1999-01-01'",
        f"{real('rate_to_rub')} AS rate_to_rub, 'feed' AS source_url",
        f"{real('rate_to_rub + 1')} AS rate_to_rub, 'feed' AS source_url"),
}
