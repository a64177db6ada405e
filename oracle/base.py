"""Building blocks: the retail tables as SQL, exact ratios, output casts.

The statements deliberately take the plain route (row-level joins, whole-table
windows) where the Spark plans take a scalable one.
"""

from __future__ import annotations

TABLES = {
    "lines": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount
        ) = 1""",
    "stores": """
        SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS store_id,
               s_name AS store_name, n_name AS city, r_name AS region,
               CASE s_suppkey % 3 WHEN 0 THEN 'Convenience' WHEN 1 THEN 'Supermarket'
                    ELSE 'Hypermarket' END AS format,
               CAST(DATE '2010-01-01' + CAST(s_suppkey % 3650 AS INTEGER) AS DATE) AS opening_date,
               CASE WHEN s_suppkey % 17 = 0 THEN 0 ELSE 400 + (s_suppkey % 8) * 200 END
                   AS store_area_sqm,
               CASE WHEN s_suppkey % 13 = 0 THEN 0 ELSE 20 + s_suppkey % 60 END AS employees_count
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
                      JOIN region ON r_regionkey = n_regionkey""",
    "products": """
        SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_id,
               CAST(10000 + p_partkey AS VARCHAR) AS stock_code, p_name AS product_name,
               p_type AS category, split_part(p_name, ' ', 2) AS subcategory, p_brand AS brand,
               'V' || CAST(p_partkey % 8 AS VARCHAR) AS supplier,
               CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.72, 2) AS DECIMAL(12,2))
                   AS unit_cost,
               CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, 'pcs' AS uom, 1 AS is_active
        FROM part""",
    "sales": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sale_id,
               CAST(l_shipdate AS DATE) AS sale_date,
               strftime(l_shipdate, '%Y-%m') AS sale_month,
               'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS store_id,
               'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS product_id,
               p_type AS category, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(round(CAST(l_extendedprice AS DECIMAL(14,2))
                    * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(14,2)) AS revenue,
               CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * 0.72, 2) AS DECIMAL(14,2))
                   AS total_cost,
               CAST(revenue - total_cost AS DECIMAL(14,2)) AS profit,
               substr(o_orderpriority, 3) AS sales_channel
        FROM lines JOIN part ON p_partkey = l_partkey
                   LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "plan_sales": """
        SELECT strftime(sale_date + INTERVAL 12 MONTH, '%Y-%m') AS plan_month, store_id, category,
               CAST(round(sum(revenue) * 1.05, 2) AS DECIMAL(24,2)) AS plan_revenue,
               CAST(round(sum(profit) * 1.05, 2) AS DECIMAL(24,2)) AS plan_profit,
               CAST(sum(quantity) AS BIGINT) AS plan_qty
        FROM sales GROUP BY ALL""",
    "inventory": """
        SELECT inventory_date, store_id, product_id, stock_qty,
               CAST(stock_qty * 10.5 AS DECIMAL(14,2)) AS stock_value, 15 AS reorder_point,
               CAST(stock_qty * 1.25 AS DECIMAL(10,2)) AS days_of_cover,
               CASE WHEN stock_qty < 15 THEN 'LOW' WHEN stock_qty > 45 THEN 'OVERSTOCK'
                    ELSE 'OK' END AS stock_status
        FROM (SELECT last_day(CAST(l_shipdate AS DATE) + CAST(31 * (l_partkey % 2) AS INTEGER))
                         AS inventory_date,
                     'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS store_id,
                     'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS product_id,
                     CAST(sum(CAST(l_quantity AS INTEGER) * 7) % 61 AS INTEGER) AS stock_qty
              FROM lines GROUP BY ALL)""",
    "currency_rates": """
        SELECT CAST(o_orderdate AS DATE) AS rate_date, substr(o_orderpriority, 3) AS currency_code,
               'Currency ' || substr(o_orderpriority, 3) AS currency_name,
               CAST(max(o_totalprice) AS DECIMAL(12,4)) AS rate_to_rub
        FROM orders GROUP BY ALL""",
}

_NEEDS = {"sales": ["lines"], "plan_sales": ["sales"], "inventory": ["lines"]}
_ORDER = list(TABLES)


def statement(tables: str, body: str, **steps: str) -> str:
    """``body`` over the named retail tables and further named steps."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        wanted.add(name)
        for other in _NEEDS.get(name, []):
            need(other)

    for name in tables.split():
        need(name)
    parts = [f"{n} AS MATERIALIZED ({TABLES[n]})" for n in _ORDER if n in wanted]
    parts += [f"{n} AS ({sql})" for n, sql in steps.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def ratio(top: str, bottom: str, digits: int = 2, times: int = 1) -> str:
    """``top / bottom * times`` half-up, by integers; operands have up to 4 decimals."""
    n = f"CAST(({top}) * 10000 AS HUGEINT)"
    d = f"CAST(({bottom}) * 10000 AS HUGEINT)"
    scale = 10**digits
    return (
        f"(CASE WHEN {d} <> 0 THEN sign({n}) * sign({d}) *"
        f" ((2 * abs({n}) * {times * scale} + abs({d})) // (2 * abs({d}))) / {scale}.0 END)"
    )


def pct(top: str, bottom: str, digits: int = 2) -> str:
    return ratio(top, bottom, digits, 100)


def real(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def whole(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def fixed(expr: str, digits: int = 2) -> str:
    """A rounded ratio as text with all its decimals."""
    return f"CAST(CAST({expr} AS DECIMAL(18,{digits})) AS VARCHAR)"


def money_text(expr: str) -> str:
    amount = f"CAST(round_even(CAST(coalesce({expr}, 0) AS DOUBLE), 0) AS BIGINT)"
    return f"replace(format('{{:,}}', {amount}), ',', ' ')"


def pct_text(expr: str) -> str:
    value = f"CAST(coalesce({expr}, 0) AS DOUBLE)"
    value = f"(CASE WHEN abs({value}) <= 1 THEN {value} * 100 ELSE {value} END)"
    return f"replace(printf('%.1f%%', {value}), '.0%', '%')"


def joined(*fields: str) -> str:
    """Fields of the rows of a group as ``a=b=c, ...`` in order of position."""
    entry = "concat_ws('=', " + ", ".join(f"CAST({f} AS VARCHAR)" for f in fields) + ")"
    return f"string_agg({entry}, ', ' ORDER BY position)"
