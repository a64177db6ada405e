"""Dashboard widgets."""

from __future__ import annotations

from .base import pct, ratio, real, statement, text, whole
from .marts import _FX_STEPS, _fan_out

SQL = {
    "executive_summary": statement("sales plan_sales inventory", f"""
        SELECT sale_month, {real('r')} AS revenue, {real('p')} AS profit,
            {pct('p', 'r')} AS margin_pct, {pct('fr', 'pr')} AS revenue_plan_completion_pct
        FROM (SELECT sale_month, sum(revenue) AS r, sum(profit) AS p FROM sales GROUP BY ALL)
        LEFT JOIN f ON plan_month = sale_month
        LEFT JOIN (SELECT DISTINCT inventory_date FROM inventory)
            ON strftime(inventory_date, '%Y-%m') = sale_month""", **_fan_out("plan_month")),
    "revenue_by_day": statement("sales", f"""
        SELECT {text('sale_date')} AS sale_date, {real('sum(revenue)')} AS revenue
        FROM sales GROUP BY sales.sale_date"""),
    "revenue_by_category": statement("sales", f"""
        SELECT category, {real('sum(revenue)')} AS revenue FROM sales GROUP BY ALL"""),
    "profit_by_brand": statement("sales products", f"""
        SELECT brand, {real('sum(profit)')} AS profit
        FROM sales LEFT JOIN products USING (product_id) GROUP BY ALL"""),
    "revenue_by_channel": statement("sales", f"""
        SELECT sales_channel, {real('r')} AS revenue,
            {pct('r', 'sum(r) OVER ()')} AS revenue_share_pct
        FROM (SELECT sales_channel, sum(revenue) AS r FROM sales GROUP BY ALL)"""),
    "revenue_by_category_of_region": statement("sales stores", f"""
        SELECT category, {real('sum(revenue)')} AS revenue FROM sales JOIN stores USING (store_id)
        WHERE region IN ('EUROPE', 'ASIA') AND sale_month >= '1998-01' AND sale_month < '1998-07'
        GROUP BY ALL"""),
    "profit_by_brand_of_some": statement("sales products", f"""
        SELECT brand, {real('sum(profit)')} AS profit FROM sales JOIN products USING (product_id)
        WHERE brand IN ('Brand#4', 'Brand#5') GROUP BY ALL"""),
    "variance_by_store_of_category": statement("sales plan_sales stores", f"""
        SELECT store_name, {real('sum(fr - pr)')} AS revenue_variance
        FROM f LEFT JOIN stores USING (store_id)
        WHERE category = 'STANDARD' AND region = 'ASIA' GROUP BY ALL""",
        **_fan_out("store_id, category")),
    "revenue_by_store": statement("sales stores", f"""
        SELECT store_name, {real('sum(revenue)')} AS revenue
        FROM sales LEFT JOIN stores USING (store_id) GROUP BY ALL"""),
    "profit_by_store": statement("sales stores", f"""
        SELECT store_name, {real('sum(profit)')} AS profit
        FROM sales LEFT JOIN stores USING (store_id) GROUP BY ALL"""),
    "revenue_per_employee_by_store": statement("sales stores", f"""
        SELECT store_name, {ratio('sum(r)', 'sum(employees_count)')} AS revenue_per_employee
        FROM (SELECT store_id, sum(revenue) AS r FROM sales GROUP BY ALL)
        LEFT JOIN stores USING (store_id) GROUP BY ALL"""),
    "revenue_per_sqm_by_store": statement("sales stores", f"""
        SELECT store_name, {ratio('sum(r)', 'sum(store_area_sqm)')} AS revenue_per_sqm
        FROM (SELECT store_id, sum(revenue) AS r FROM sales GROUP BY ALL)
        LEFT JOIN stores USING (store_id) GROUP BY ALL"""),
    "plan_fact_kpis": statement("sales plan_sales", f"""
        SELECT {real('sum(pr)')} AS plan_revenue, {real('sum(fr)')} AS fact_revenue,
            {pct('sum(fr)', 'sum(pr)')} AS revenue_plan_completion_pct FROM f""",
        **_fan_out("plan_month")),
    "sales_table": statement("sales stores products", f"""
        SELECT store_name, product_name, sales.category AS category,
            {real('sum(revenue)')} AS revenue, {real('sum(profit)')} AS profit,
            {pct('sum(profit)', 'sum(revenue)')} AS margin_pct
        FROM sales LEFT JOIN stores USING (store_id) LEFT JOIN products USING (product_id)
        GROUP BY ALL"""),
    "store_table": statement("sales stores", f"""
        SELECT sale_month, store_name, city, region, {real('r')} AS revenue,
            {real('p')} AS profit, {pct('p', 'r')} AS margin_pct,
            {ratio('r', 'employees_count')} AS revenue_per_employee,
            {ratio('r', 'store_area_sqm')} AS revenue_per_sqm
        FROM (SELECT sale_month, store_id, sum(revenue) AS r, sum(profit) AS p
              FROM sales GROUP BY ALL) LEFT JOIN stores USING (store_id)"""),
    "plan_fact_by_category_widget": statement("sales plan_sales", f"""
        SELECT category, {real('pr')} AS plan_revenue, {real('fr')} AS fact_revenue FROM f""",
        **_fan_out("category")),
    "variance_by_store": statement("sales plan_sales stores", f"""
        SELECT store_name, {real('sum(fr - pr)')} AS revenue_variance
        FROM f LEFT JOIN stores USING (store_id) GROUP BY ALL""", **_fan_out("store_id")),
    "plan_fact_table": statement("sales plan_sales stores", f"""
        SELECT plan_month, store_name, category, {real('pr')} AS plan_revenue,
            {real('fr')} AS fact_revenue, {real('fr - pr')} AS revenue_variance,
            {pct('fr', 'pr')} AS revenue_plan_completion_pct
        FROM f LEFT JOIN stores USING (store_id)""",
        **_fan_out("plan_month, store_id, category")),
    "stock_value_by_category": statement("inventory products", f"""
        SELECT category, {real('sum(stock_value)')} AS stock_value
        FROM inventory LEFT JOIN products USING (product_id) GROUP BY ALL"""),
    "stock_status_by_region": statement("inventory stores", """
        SELECT region, stock_status, count(*) AS positions
        FROM inventory LEFT JOIN stores USING (store_id) GROUP BY ALL"""),
    "inventory_kpis": statement("inventory", f"""
        SELECT {text('inventory_date')} AS inventory_date, {real('sum(stock_value)')} AS stock_value,
            count(*) FILTER (stock_status = 'LOW') AS low_stock_positions,
            count(*) FILTER (stock_status = 'OVERSTOCK') AS overstock_positions
        FROM inventory GROUP BY inventory.inventory_date"""),
    "inventory_table": statement("inventory stores products", f"""
        SELECT {text('inventory_date')} AS inventory_date, store_name, product_name, category,
            {whole('stock_qty')} AS stock_qty, {whole('reorder_point')} AS reorder_point,
            {real('days_of_cover')} AS days_of_cover, stock_status
        FROM inventory LEFT JOIN stores USING (store_id) LEFT JOIN products USING (product_id)"""),
    "fx_page": statement("sales currency_rates", f"""
        SELECT report_month, currency_code, avg_rate_to_rub, avg_rate_mom_pct,
            {ratio('r', 'rate')} AS revenue_in_currency, {ratio('p', 'rate')} AS profit_in_currency,
            {ratio('c * mom', '100')} AS estimated_cost_pressure_rub,
            CASE WHEN mom >= 5 THEN 'HIGH' WHEN mom >= 2 THEN 'MODERATE'
                 WHEN mom <= -2 THEN 'EASING' ELSE 'STABLE' END AS fx_risk_status
        FROM (SELECT *, coalesce(CAST(avg_rate_mom_pct AS DECIMAL(10,2)), 0) AS mom
              FROM fx_mom)""", **_FX_STEPS),
}
