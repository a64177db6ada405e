"""Marts."""

from __future__ import annotations

from .base import pct, ratio, real, statement, text, whole

STORE = "store_name, city, region, format AS store_format"

_TOTALS = f"""{real('sum(revenue)')} AS revenue, {real('sum(total_cost)')} AS total_cost,
    {real('sum(profit)')} AS profit, {whole('sum(quantity)')} AS quantity"""

# plan joined to single sale rows, as the fan-out marts define it
FANNED = """
    SELECT plan_month, p.store_id, p.category, plan_revenue, plan_profit, plan_qty,
           s.revenue, s.profit, s.quantity
    FROM plan_sales AS p LEFT JOIN sales AS s
      ON p.plan_month = s.sale_month AND p.store_id = s.store_id AND p.category = s.category"""

FANNED_SUMS = """
    sum(plan_revenue) AS pr, sum(plan_profit) AS pp, sum(plan_qty) AS pq,
    coalesce(sum(revenue), 0) AS fr, coalesce(sum(profit), 0) AS fp, coalesce(sum(quantity), 0) AS fq"""

_PLAN_OUT = f"""{real('pr')} AS plan_revenue, {real('pp')} AS plan_profit, {whole('pq')} AS plan_qty"""
_FACT_OUT = f"""{real('fr')} AS fact_revenue, {real('fp')} AS fact_profit, {whole('fq')} AS fact_qty"""
_VARIANCE_OUT = f"""{real('fr - pr')} AS revenue_variance, {real('fp - pp')} AS profit_variance,
    {pct('fr', 'pr')} AS revenue_plan_completion_pct,
    {pct('fp', 'pp')} AS profit_plan_completion_pct"""

MONTHLY_RATES = f"""
    SELECT strftime(rate_date, '%Y-%m') AS report_month, currency_code, currency_name,
           {ratio('sum(rate_to_rub)', 'count(*)', 4)} AS avg_rate_to_rub,
           min(rate_to_rub) AS lowest, max(rate_to_rub) AS highest,
           arg_min(rate_to_rub, rate_date) AS opening, arg_max(rate_to_rub, rate_date) AS closing,
           {pct('(max(rate_to_rub) - min(rate_to_rub)) * count(*)', 'sum(rate_to_rub)')}
               AS monthly_volatility_pct,
           count(*) AS observations
    FROM currency_rates GROUP BY ALL"""

_FX_STEPS = dict(
    rates=f"""SELECT *, {pct('closing - opening', 'opening')} AS monthly_change_pct
              FROM ({MONTHLY_RATES})""",
    months="""SELECT sale_month AS report_month, sum(revenue) AS r, sum(total_cost) AS c,
                     sum(profit) AS p, sum(quantity) AS q
              FROM sales GROUP BY sale_month""",
    fx=f"""SELECT *, CAST(avg_rate_to_rub AS DECIMAL(12,4)) AS rate,
                  lag(CAST(avg_rate_to_rub AS DECIMAL(12,4))) OVER w AS rate0, lag(r) OVER w AS r0
           FROM months JOIN rates USING (report_month)
           WINDOW w AS (PARTITION BY currency_code ORDER BY report_month)""",
    fx_mom=f"""SELECT *, {pct('rate - rate0', 'rate0')} AS avg_rate_mom_pct,
                      {pct('r - r0', 'r0')} AS revenue_rub_mom_pct, {pct('p', 'r')} AS margin_pct
               FROM fx""",
)

# sales, plan and stock meeting on month, store and category; null keys never match
KPI_STEPS = dict(
    s="""SELECT sale_month AS m, store_id AS st, category AS cat, sum(revenue) AS rev,
                sum(total_cost) AS cost, sum(profit) AS prof, sum(quantity) AS qty,
                count(*) AS n, count(DISTINCT product_id) AS items
         FROM sales GROUP BY ALL""",
    p="""SELECT plan_month AS m, store_id AS st, category AS cat, sum(plan_revenue) AS prev,
                sum(plan_profit) AS pprof, sum(plan_qty) AS pqty
         FROM plan_sales GROUP BY ALL""",
    i="""SELECT strftime(inventory_date, '%Y-%m') AS m, store_id AS st, products.category AS cat,
                sum(stock_qty) AS sq, sum(stock_value) AS sv, sum(days_of_cover) AS cover,
                count(*) FILTER (stock_status = 'LOW') AS low,
                count(*) FILTER (stock_status = 'OVERSTOCK') AS excess,
                count(*) FILTER (stock_status = 'OK') AS fine, count(*) AS positions
         FROM inventory LEFT JOIN products USING (product_id) GROUP BY ALL""",
    kpi=f"""SELECT m, st, cat,
                coalesce(rev, 0) AS fact_revenue, coalesce(cost, 0) AS fact_cost,
                coalesce(prof, 0) AS fact_profit, coalesce(qty, 0) AS fact_qty,
                coalesce(n, 0) AS sales_rows, coalesce(items, 0) AS sold_products,
                coalesce({pct('prof', 'rev')}, 0) AS margin_pct,
                coalesce({ratio('rev', 'qty')}, 0) AS avg_unit_revenue,
                coalesce(prev, 0) AS plan_revenue, coalesce(pprof, 0) AS plan_profit,
                coalesce(pqty, 0) AS plan_qty,
                fact_revenue - plan_revenue AS revenue_variance,
                fact_profit - plan_profit AS profit_variance,
                {pct('coalesce(rev, 0)', 'prev')} AS revenue_plan_completion_pct,
                {pct('coalesce(prof, 0)', 'pprof')} AS profit_plan_completion_pct,
                coalesce(sq, 0) AS stock_qty, coalesce(sv, 0) AS stock_value,
                coalesce({ratio('cover', 'positions')}, 0) AS avg_days_of_cover,
                coalesce(low, 0) AS low_stock_positions,
                coalesce(excess, 0) AS overstock_positions,
                coalesce(fine, 0) AS ok_stock_positions,
                coalesce(positions, 0) AS inventory_positions,
                {ratio('coalesce(rev, 0)', 'sv', 4)} AS stock_turnover_revenue_ratio,
                CASE WHEN low > 0 AND rev > 0 THEN 'LOST_SALES_RISK'
                     WHEN excess > 0 THEN 'OVERSTOCK'
                     WHEN coalesce(rev, 0) < coalesce(prev, 0) THEN 'BELOW_PLAN'
                     ELSE 'NORMAL' END AS management_status
            FROM s FULL JOIN p USING (m, st, cat) FULL JOIN i USING (m, st, cat)""",
)


def _fan_out(keys: str) -> dict[str, str]:
    return dict(fanned=FANNED, f=f"SELECT {keys}, {FANNED_SUMS} FROM fanned GROUP BY ALL")


SQL = {
    "sales_enriched": statement("sales stores products", f"""
        SELECT sale_id, {text('sale_date')} AS sale_date, sale_month,
            {whole('year(sale_date)')} AS sale_year, {whole('quarter(sale_date)')} AS sale_quarter,
            {whole('month(sale_date)')} AS sale_month_num, {whole('weekofyear(sale_date)')} AS sale_week,
            {whole('dayofweek(sale_date)')} AS day_of_week_num,
            {whole('CASE WHEN isodow(sale_date) >= 6 THEN 1 ELSE 0 END')} AS is_weekend,
            store_id, {STORE}, {whole('store_area_sqm')} AS store_area_sqm,
            {whole('employees_count')} AS employees_count, product_id, product_name, stock_code,
            sales.category AS category, subcategory, brand, supplier, uom, sales_channel,
            {whole('quantity')} AS quantity, {real('revenue')} AS revenue,
            {real('total_cost')} AS total_cost, {real('profit')} AS profit,
            {pct('profit', 'revenue')} AS margin_pct, {ratio('revenue', 'quantity')} AS avg_unit_revenue,
            {ratio('profit', 'quantity')} AS profit_per_unit,
            {ratio('revenue', 'employees_count')} AS revenue_per_employee,
            {ratio('revenue', 'store_area_sqm')} AS revenue_per_sqm
        FROM sales LEFT JOIN stores USING (store_id) LEFT JOIN products USING (product_id)"""),
    "monthly_sales_kpi": statement("sales", f"""
        SELECT sale_month, {whole('year(sale_date)')} AS sale_year,
            {whole('month(sale_date)')} AS sale_month_num, {_TOTALS},
            count(*) AS sales_rows, count(DISTINCT store_id) AS active_stores,
            count(DISTINCT product_id) AS active_products,
            {pct('sum(profit)', 'sum(revenue)')} AS margin_pct,
            {ratio('sum(revenue)', 'count(*)')} AS avg_sale_row_revenue
        FROM sales GROUP BY ALL"""),
    "store_performance": statement("sales stores", f"""
        SELECT sale_month, store_id, {STORE}, {whole('store_area_sqm')} AS store_area_sqm,
            {whole('employees_count')} AS employees_count, {_TOTALS},
            count(*) AS sales_rows, count(DISTINCT product_id) AS active_products,
            {pct('sum(profit)', 'sum(revenue)')} AS margin_pct,
            {ratio('sum(revenue)', 'any_value(employees_count)')} AS revenue_per_employee,
            {ratio('sum(revenue)', 'any_value(store_area_sqm)')} AS revenue_per_sqm
        FROM sales LEFT JOIN stores USING (store_id) GROUP BY ALL"""),
    "category_performance": statement("sales products", f"""
        SELECT sale_month, category, subcategory, brand, supplier, {real('revenue')} AS revenue,
            {real('total_cost')} AS total_cost, {real('profit')} AS profit,
            {whole('quantity')} AS quantity, sales_rows, active_stores,
            {pct('profit', 'revenue')} AS margin_pct,
            {pct('revenue', 'sum(revenue) OVER (PARTITION BY sale_month)')} AS revenue_share_pct
        FROM (SELECT sale_month, sales.category AS category, subcategory, brand, supplier,
                  sum(revenue) AS revenue, sum(total_cost) AS total_cost, sum(profit) AS profit,
                  sum(quantity) AS quantity, count(*) AS sales_rows,
                  count(DISTINCT store_id) AS active_stores
              FROM sales LEFT JOIN products USING (product_id) GROUP BY ALL)"""),
    "monthly_kpi": statement("sales", f"""
        SELECT sale_month, {real('sum(revenue)')} AS revenue, {real('sum(profit)')} AS profit,
            {whole('sum(quantity)')} AS quantity, count(*) AS sales_count
        FROM sales GROUP BY ALL"""),
    "store_monthly": statement("sales", f"""
        SELECT sale_month, store_id, {real('sum(revenue)')} AS revenue,
            {real('sum(profit)')} AS profit, {whole('sum(quantity)')} AS quantity
        FROM sales GROUP BY ALL"""),
    "category_monthly": statement("sales", f"""
        SELECT sale_month, category, {real('sum(revenue)')} AS revenue,
            {real('sum(profit)')} AS profit, {whole('sum(quantity)')} AS quantity
        FROM sales GROUP BY ALL"""),
    "category_plan_fact": statement("sales plan_sales", f"""
        SELECT m AS report_month, category, {_PLAN_OUT}, {_FACT_OUT}, {_VARIANCE_OUT}
        FROM (SELECT m, category, pr, pp, pq, coalesce(fr, 0) AS fr, coalesce(fp, 0) AS fp,
                  coalesce(fq, 0) AS fq
              FROM (SELECT plan_month AS m, category, sum(plan_revenue) AS pr,
                        sum(plan_profit) AS pp, sum(plan_qty) AS pq
                    FROM plan_sales GROUP BY ALL)
              LEFT JOIN (SELECT sale_month AS m, category, sum(revenue) AS fr, sum(profit) AS fp,
                             sum(quantity) AS fq
                         FROM sales GROUP BY ALL) USING (m, category))"""),
    "plan_fact_dashboard": statement("sales plan_sales stores", f"""
        SELECT plan_month, store_id, {STORE}, category, {_PLAN_OUT}, {_FACT_OUT}, {_VARIANCE_OUT}
        FROM f LEFT JOIN stores USING (store_id)""",
        **_fan_out("plan_month, store_id, category")),
    "plan_fact_trend": statement("sales plan_sales", f"""
        SELECT m AS trend_month, {real('coalesce(pr, 0)')} AS plan_revenue,
            {real('coalesce(pp, 0)')} AS plan_profit, {whole('coalesce(pq, 0)')} AS plan_qty,
            {real('coalesce(fr, 0)')} AS fact_revenue, {real('coalesce(fp, 0)')} AS fact_profit,
            {whole('coalesce(fq, 0)')} AS fact_qty,
            {real('coalesce(fr, 0) - coalesce(pr, 0)')} AS revenue_variance,
            {pct('coalesce(fr, 0)', 'pr')} AS revenue_plan_completion_pct
        FROM (SELECT plan_month AS m, sum(plan_revenue) AS pr, sum(plan_profit) AS pp,
                  sum(plan_qty) AS pq FROM plan_sales GROUP BY ALL)
        FULL JOIN (SELECT sale_month AS m, sum(revenue) AS fr, sum(profit) AS fp,
                       sum(quantity) AS fq FROM sales GROUP BY ALL) USING (m)"""),
    "plan_fact_summary": statement("sales plan_sales", f"""
        SELECT plan_month, {_PLAN_OUT}, {_FACT_OUT}, {pct('fr', 'pr')} AS plan_revenue_pct,
            {pct('fp', 'pp')} AS plan_profit_pct
        FROM f""", **_fan_out("plan_month")),
    "inventory_risks": statement("inventory stores products", f"""
        SELECT {text('inventory_date')} AS inventory_date, store_id, {STORE}, product_id,
            product_name, category, subcategory, brand, supplier, {whole('stock_qty')} AS stock_qty,
            {real('stock_value')} AS stock_value, {whole('reorder_point')} AS reorder_point,
            {real('days_of_cover')} AS days_of_cover, stock_status,
            {whole("stock_status = 'LOW'")} AS is_low_stock,
            {whole("stock_status = 'OVERSTOCK'")} AS is_overstock,
            {whole('stock_qty - reorder_point')} AS stock_vs_reorder_qty
        FROM inventory LEFT JOIN stores USING (store_id) LEFT JOIN products USING (product_id)"""),
    "inventory_summary": statement("inventory", f"""
        SELECT {text('inventory_date')} AS inventory_date,
            {whole('sum(stock_qty)')} AS total_stock_qty, {real('sum(stock_value)')} AS total_stock_value
        FROM inventory GROUP BY inventory_date"""),
    "inventory_alerts": statement("inventory", f"""
        SELECT {text('inventory_date')} AS inventory_date, store_id, product_id,
            {whole('stock_qty')} AS stock_qty, {real('stock_value')} AS stock_value,
            {whole('reorder_point')} AS reorder_point, {real('days_of_cover')} AS days_of_cover,
            stock_status
        FROM inventory"""),
    "dashboard_summary": statement("sales plan_sales inventory", f"""
        SELECT sale_month, {real('k.r')} AS revenue, {real('k.p')} AS profit,
            {real('k.q')} AS quantity, {pct('k.p', 'k.r')} AS margin_pct,
            {real('pr')} AS plan_revenue, {real('fr')} AS fact_revenue,
            {pct('fr', 'pr')} AS revenue_plan_completion_pct,
            {text('d')} AS latest_inventory_date, {real('units')} AS total_stock_qty,
            {real('worth')} AS total_stock_value, {real('low')} AS low_stock_positions,
            {real('excess')} AS overstock_positions
        FROM (SELECT sale_month, sum(revenue) AS r, sum(profit) AS p, sum(quantity) AS q
              FROM sales GROUP BY ALL) AS k
        LEFT JOIN f ON plan_month = sale_month
        LEFT JOIN (SELECT inventory_date AS d, sum(stock_qty) AS units, sum(stock_value) AS worth,
                       count(*) FILTER (stock_status = 'LOW') AS low,
                       count(*) FILTER (stock_status = 'OVERSTOCK') AS excess
                   FROM inventory GROUP BY ALL) ON strftime(d, '%Y-%m') = sale_month""",
        **_fan_out("plan_month")),
    "currency_rates_monthly": statement("currency_rates", f"""
        SELECT report_month, currency_code, currency_name, avg_rate_to_rub,
            {real('lowest')} AS min_rate_to_rub, {real('highest')} AS max_rate_to_rub,
            {real('opening')} AS first_rate_to_rub, {real('closing')} AS last_rate_to_rub,
            {pct('closing - opening', 'opening')} AS monthly_change_pct,
            monthly_volatility_pct, observations
        FROM ({MONTHLY_RATES})"""),
    "sales_fx_monthly": statement("sales currency_rates", f"""
        SELECT report_month, currency_code, currency_name, {real('r')} AS revenue_rub,
            {real('c')} AS total_cost_rub, {real('p')} AS profit_rub, {whole('q')} AS quantity,
            margin_pct, avg_rate_to_rub, monthly_change_pct, monthly_volatility_pct,
            {ratio('r', 'rate')} AS revenue_in_currency,
            {ratio('c', 'rate')} AS total_cost_in_currency,
            {ratio('p', 'rate')} AS profit_in_currency, avg_rate_mom_pct, revenue_rub_mom_pct
        FROM fx_mom""", **_FX_STEPS),
    "fx_risk_metrics": statement("sales currency_rates", f"""
        SELECT report_month, currency_code, currency_name, {real('r')} AS revenue_rub,
            {real('c')} AS total_cost_rub, {real('p')} AS profit_rub, margin_pct, avg_rate_to_rub,
            avg_rate_mom_pct, {ratio('c * mom', '100')} AS estimated_cost_pressure_rub,
            {ratio('p * 100 - c * mom', 'r')} AS margin_after_fx_pressure_pct,
            CASE WHEN mom >= 5 THEN 'HIGH' WHEN mom >= 2 THEN 'MODERATE'
                 WHEN mom <= -2 THEN 'EASING' ELSE 'STABLE' END AS fx_risk_status
        FROM (SELECT *, coalesce(CAST(avg_rate_mom_pct AS DECIMAL(10,2)), 0) AS mom
              FROM fx_mom)""", **_FX_STEPS),
    "retail_kpi_mart": statement("sales plan_sales inventory products stores", f"""
        SELECT m AS report_month, st AS store_id, {STORE}, cat AS category,
            {real('fact_revenue')} AS fact_revenue, {real('fact_cost')} AS fact_cost,
            {real('fact_profit')} AS fact_profit, {whole('fact_qty')} AS fact_qty, sales_rows,
            sold_products, margin_pct, avg_unit_revenue, {real('plan_revenue')} AS plan_revenue,
            {real('plan_profit')} AS plan_profit, {whole('plan_qty')} AS plan_qty,
            {real('revenue_variance')} AS revenue_variance,
            {real('profit_variance')} AS profit_variance, revenue_plan_completion_pct,
            profit_plan_completion_pct, {whole('stock_qty')} AS stock_qty,
            {real('stock_value')} AS stock_value, avg_days_of_cover, low_stock_positions,
            overstock_positions, ok_stock_positions, inventory_positions,
            stock_turnover_revenue_ratio, management_status
        FROM kpi LEFT JOIN stores ON store_id = st""", **KPI_STEPS),
    "store_monthly_heatmap": statement("sales plan_sales inventory products stores", f"""
        SELECT m AS report_month, st AS store_id, {STORE}, {real('fr')} AS fact_revenue,
            {real('fp')} AS fact_profit, {real('pr')} AS plan_revenue,
            {real('gap')} AS revenue_variance, {pct('fr', 'pr')} AS revenue_plan_completion_pct,
            {pct('fp', 'fr')} AS margin_pct, {real('sv')} AS stock_value,
            {whole('low')} AS low_stock_positions, {whole('excess')} AS overstock_positions,
            avg_days_of_cover,
            rank() OVER (PARTITION BY m ORDER BY fr DESC) AS revenue_rank,
            rank() OVER (PARTITION BY m ORDER BY fp DESC) AS profit_rank,
            rank() OVER (PARTITION BY m ORDER BY gap) AS underplan_rank
        FROM (SELECT m, st, sum(fact_revenue) AS fr, sum(fact_profit) AS fp,
                  sum(plan_revenue) AS pr, sum(revenue_variance) AS gap, sum(stock_value) AS sv,
                  sum(low_stock_positions) AS low, sum(overstock_positions) AS excess,
                  {ratio('sum(CAST(avg_days_of_cover AS DECIMAL(12,2)))',
                         'count(*) FILTER (avg_days_of_cover <> 0)')} AS avg_days_of_cover
              FROM kpi GROUP BY ALL)
        LEFT JOIN stores ON store_id = st""", **KPI_STEPS),
    "abc_xyz_analysis": statement("sales products", f"""
        SELECT product_id, product_name, t.category AS category, subcategory, brand, supplier,
            {real('revenue')} AS revenue, {real('profit')} AS profit,
            {whole('units')} AS quantity, active_months, {pct('profit', 'revenue')} AS margin_pct,
            {pct('revenue', 'everything', 4)} AS revenue_share_pct,
            {pct('so_far', 'everything', 4)} AS cumulative_revenue_share_pct, abc_class,
            CASE WHEN units <> 0 THEN
                floor(sqrt(CAST(spread AS DOUBLE)) / CAST(units AS DOUBLE) * 10000 + 0.5) / 100
            END AS demand_cv_pct,
            xyz_class, abc_class || xyz_class AS abc_xyz_class
        FROM (SELECT *,
                  CASE WHEN {pct('so_far', 'everything', 4)} <= 80 THEN 'A'
                       WHEN {pct('so_far', 'everything', 4)} <= 95 THEN 'B' ELSE 'C' END AS abc_class,
                  CASE WHEN units = 0 THEN 'Z' WHEN 100 * spread <= units * units THEN 'X'
                       WHEN 16 * spread <= units * units THEN 'Y' ELSE 'Z' END AS xyz_class
              FROM (SELECT *, sum(revenue) OVER () AS everything,
                        sum(revenue) OVER (ORDER BY revenue DESC, product_id, category
                                           ROWS UNBOUNDED PRECEDING) AS so_far
                    FROM totals)) AS t
        LEFT JOIN products USING (product_id)""",
        months="""SELECT sale_month, product_id, category, sum(revenue) AS r, sum(profit) AS p,
                      sum(quantity) AS q
                  FROM sales GROUP BY ALL""",
        totals="""SELECT product_id, category, sum(r) AS revenue, sum(p) AS profit,
                      sum(q) AS units, count(*) AS active_months,
                      count(*) * sum(q * q) - sum(q) * sum(q) AS spread
                  FROM months GROUP BY ALL"""),
    "inventory_turnover": statement("sales inventory stores products", f"""
        SELECT m AS report_month, store_id, store_name, region, product_id, product_name,
            coalesce(sale_category, products.category) AS category, brand,
            {whole('coalesce(sold, 0)')} AS sold_qty, {real('coalesce(rev, 0)')} AS revenue,
            {real('coalesce(prof, 0)')} AS profit, {whole('coalesce(stock, 0)')} AS stock_qty,
            {real('coalesce(worth, 0)')} AS stock_value,
            coalesce({ratio('cover', 'n')}, 0) AS avg_days_of_cover, stock_status,
            {real('CASE WHEN stock <> 0 THEN CAST(coalesce(sold, 0) AS BIGINT) // CAST(stock AS BIGINT) END')}
                AS qty_turnover_ratio,
            {ratio('coalesce(rev, 0)', 'worth', 4)} AS value_turnover_ratio,
            CASE WHEN coalesce(sold, 0) = 0 AND stock > 0 THEN 'NO_SALES'
                 WHEN coalesce(stock, 0) = 0 AND sold > 0 THEN 'NO_STOCK'
                 WHEN coalesce(cover / n, 0) < 7 THEN 'SHORTAGE_RISK'
                 WHEN cover / n > 45 THEN 'EXCESS_RISK' ELSE 'NORMAL' END AS turnover_status
        FROM (SELECT sale_month AS m, store_id, product_id, category AS sale_category,
                  sum(quantity) AS sold, sum(revenue) AS rev, sum(profit) AS prof
              FROM sales GROUP BY ALL)
        FULL JOIN (SELECT strftime(inventory_date, '%Y-%m') AS m, store_id, product_id,
                       sum(stock_qty) AS stock, sum(stock_value) AS worth,
                       sum(days_of_cover) AS cover, count(*) AS n, max(stock_status) AS stock_status
                   FROM inventory GROUP BY ALL) USING (m, store_id, product_id)
        LEFT JOIN stores USING (store_id) LEFT JOIN products USING (product_id)"""),
}

for _key, _name in (("store_id", "plan_fact_store"), ("category", "plan_fact_category")):
    SQL[_name] = statement("sales plan_sales", f"""
        SELECT plan_month, {_key}, {real('pr')} AS plan_revenue, {real('fr')} AS fact_revenue,
            {pct('fr', 'pr')} AS plan_revenue_pct, {real('pp')} AS plan_profit,
            {real('fp')} AS fact_profit, {pct('fp', 'pp')} AS plan_profit_pct
        FROM f""", **_fan_out(f"plan_month, {_key}"))

# folded from days with sketches; these count one by one while values are few
SQL["monthly_sales_kpi_sketched"] = SQL["monthly_sales_kpi"]
SQL["store_performance_sketched"] = SQL["store_performance"]
SQL["category_stores_sketched"] = statement("sales products", f"""
    SELECT sale_month, sales.category AS category, subcategory, brand, supplier, {_TOTALS},
        count(*) AS sales_rows, count(DISTINCT store_id) AS active_stores,
        {pct('sum(profit)', 'sum(revenue)')} AS margin_pct
    FROM sales LEFT JOIN products USING (product_id) GROUP BY ALL""")
