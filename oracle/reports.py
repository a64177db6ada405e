"""Rankings, reports, narratives and fact lists."""

from __future__ import annotations

from .base import fixed, joined, money_text, pct, pct_text, real, statement, text, whole
from .marts import _fan_out

_STORE = "SELECT sale_month, store_id AS name, sum(revenue) AS r, sum(profit) AS p, sum(quantity) AS q FROM sales GROUP BY ALL"
_CATEGORY = _STORE.replace("store_id", "category")


def _ranked(rows: str, direction: str) -> str:
    return (
        f"SELECT *, row_number() OVER (PARTITION BY sale_month ORDER BY r {direction}, name)"
        f" AS position FROM ({rows}) QUALIFY position <= 3"
    )


_LISTS = {
    "top_stores": _ranked(_STORE, "DESC"), "low_stores": _ranked(_STORE, "ASC"),
    "top_categories": _ranked(_CATEGORY, "DESC"), "low_categories": _ranked(_CATEGORY, "ASC"),
}


def _worst(key: str) -> str:
    return f"""
        SELECT *, row_number() OVER (PARTITION BY plan_month ORDER BY done NULLS LAST, {key})
               AS position
        FROM (SELECT *, {pct('fr', 'pr')} AS done, {pct('fp', 'pp')} AS done_profit
              FROM (SELECT plan_month, {key}, sum(plan_revenue) AS pr, sum(plan_profit) AS pp,
                        coalesce(sum(revenue), 0) AS fr, coalesce(sum(profit), 0) AS fp
                    FROM fanned GROUP BY ALL))
        QUALIFY position <= 5"""


_POSITIONS = """
    SELECT *, row_number() OVER (PARTITION BY inventory_date, stock_status
                                 ORDER BY stock_value DESC, store_id, product_id) AS position
    FROM inventory QUALIFY position <= 10"""

SQL: dict[str, str] = {}

for _name, _rows in _LISTS.items():
    _key = "store_id" if "stores" in _name else "category"
    SQL[_name] = statement("sales", f"""
        SELECT sale_month, name AS {_key}, {real('r')} AS revenue, {real('p')} AS profit,
            {whole('q')} AS quantity, position FROM ({_rows})""")

for _name, _key in (("worst_stores_by_plan", "store_id"),
                    ("worst_categories_by_plan", "category")):
    SQL[_name] = statement("sales plan_sales", f"""
        SELECT plan_month, {_key}, {real('pr')} AS plan_revenue, {real('fr')} AS fact_revenue,
            done AS plan_revenue_pct, {real('pp')} AS plan_profit, {real('fp')} AS fact_profit,
            done_profit AS plan_profit_pct, position
        FROM ({_worst(_key)})""", **_fan_out("plan_month"))

for _name, _status in (("low_stock_top", "LOW"), ("overstock_top", "OVERSTOCK")):
    SQL[_name] = statement("inventory", f"""
        SELECT {text('inventory_date')} AS inventory_date, store_id, product_id,
            {whole('stock_qty')} AS stock_qty, {real('stock_value')} AS stock_value,
            {whole('reorder_point')} AS reorder_point, {real('days_of_cover')} AS days_of_cover,
            stock_status, position
        FROM ({_POSITIONS}) WHERE stock_status = '{_status}'""")


def _status(value: str) -> str:
    return (f"CASE WHEN {value} < 100 THEN 'NOT_MET' WHEN {value} = 100 THEN 'MET'"
            f" WHEN {value} > 100 THEN 'EXCEEDED' END")


SQL["plan_status"] = statement("sales plan_sales", f"""
    SELECT plan_month, {pct('fr', 'pr')} AS plan_revenue_pct, {pct('fp', 'pp')} AS plan_profit_pct,
        {_status('plan_revenue_pct')} AS revenue_status, {_status('plan_profit_pct')} AS profit_status
    FROM f""", **_fan_out("plan_month"))

# ---- reports as one flat row per period ----

_MONTHLY_STEPS = dict(
    **_fan_out("plan_month"),
    kpi="""SELECT sale_month AS month, sum(revenue) AS r, sum(profit) AS p, sum(quantity) AS q,
               count(*) AS n FROM sales GROUP BY ALL""",
    plan=f"""SELECT plan_month AS month, pr, pp, pq, fr, fp, fq, {pct('fr', 'pr')} AS done,
                 {pct('fp', 'pp')} AS done_profit FROM f""",
    **{name: f"""SELECT sale_month AS month, {joined('name', 'r', 'p', 'q')} AS full_list,
                     string_agg(name, ', ' ORDER BY position) AS names,
                     min(name) FILTER (position = 1) AS first
                 FROM ({rows}) GROUP BY ALL""" for name, rows in _LISTS.items()},
    monthly="""SELECT month, r, p, q, n, pr, pp, pq, fr, fp, fq, done, done_profit,
                   ts.full_list AS top_stores, ts.names AS ts_names, ts.first AS ts_first,
                   ls.full_list AS low_stores, ls.names AS ls_names, ls.first AS ls_first,
                   tc.full_list AS top_categories, tc.names AS tc_names, tc.first AS tc_first,
                   lc.full_list AS low_categories, lc.names AS lc_names, lc.first AS lc_first
               FROM kpi FULL JOIN plan USING (month) LEFT JOIN top_stores AS ts USING (month)
                   LEFT JOIN low_stores AS ls USING (month)
                   LEFT JOIN top_categories AS tc USING (month)
                   LEFT JOIN low_categories AS lc USING (month)""",
)

_PLAN_STEPS = dict(
    **_fan_out("plan_month"),
    **{name: f"""SELECT plan_month, {joined(key, 'pr', 'fr', fixed('done'), 'pp', 'fp',
                                            fixed('done_profit'))} AS full_list,
                     string_agg({key}, ', ' ORDER BY position) AS names,
                     min({key}) FILTER (position = 1) AS first
                 FROM ({_worst(key)}) GROUP BY ALL"""
       for name, key in (("worst_stores", "store_id"), ("worst_categories", "category"))},
    plan=f"""SELECT plan_month AS month, pr, pp, pq, fr, fp, fq, {pct('fr', 'pr')} AS done,
                 {pct('fp', 'pp')} AS done_profit, ws.full_list AS worst_stores_by_plan,
                 ws.names AS ws_names, ws.first AS ws_first,
                 wc.full_list AS worst_categories_by_plan, wc.names AS wc_names,
                 wc.first AS wc_first
             FROM f JOIN worst_stores AS ws USING (plan_month)
                    JOIN worst_categories AS wc USING (plan_month)""",
)

_STOCK_FIELDS = ("store_id", "product_id", "stock_qty", "stock_value", "reorder_point",
                 "days_of_cover", "stock_status")
_STOCK_STEPS = dict(
    picked=_POSITIONS,
    stock=f"""SELECT CAST(inventory_date AS VARCHAR) AS report_date, units, worth,
                  coalesce(low, '') AS low_stock, coalesce(nl, 0) AS nl,
                  coalesce(excess, '') AS overstock, coalesce(nx, 0) AS nx
              FROM (SELECT inventory_date, sum(stock_qty) AS units, sum(stock_value) AS worth
                    FROM inventory GROUP BY ALL)
              LEFT JOIN (SELECT inventory_date, {joined(*_STOCK_FIELDS)} AS low, count(*) AS nl
                         FROM picked WHERE stock_status = 'LOW' GROUP BY ALL)
                  USING (inventory_date)
              LEFT JOIN (SELECT inventory_date, {joined(*_STOCK_FIELDS)} AS excess, count(*) AS nx
                         FROM picked WHERE stock_status = 'OVERSTOCK' GROUP BY ALL)
                  USING (inventory_date)""",
)


def _plan_out(prefix: str, revenue_nullable: bool) -> str:
    count = real if revenue_nullable else whole
    return f"""{real('pr')} AS {prefix}_plan_revenue, {real('pp')} AS {prefix}_plan_profit,
        {count('pq')} AS {prefix}_plan_qty, {real('fr')} AS {prefix}_fact_revenue,
        {real('fp')} AS {prefix}_fact_profit, {count('fq')} AS {prefix}_fact_qty,
        done AS {prefix}_plan_revenue_pct, done_profit AS {prefix}_plan_profit_pct"""


_LIST_COLUMNS = ", ".join(f"coalesce({c}, '') AS {c}" for c in _LISTS)
_ALWAYS = f"{whole('1')} AS has_data"

SQL["report_monthly"] = statement("sales plan_sales", f"""
    SELECT month, {real('r')} AS kpi_revenue, {real('p')} AS kpi_profit,
        {real('q')} AS kpi_quantity, {real('n')} AS kpi_sales_count, {_LIST_COLUMNS},
        {_plan_out('plan_fact', True)}, {_ALWAYS}
    FROM monthly""", **_MONTHLY_STEPS)

SQL["report_plan_fact"] = statement("sales plan_sales", f"""
    SELECT month, {_plan_out('summary', False)}, worst_stores_by_plan, worst_categories_by_plan,
        {_ALWAYS}
    FROM plan""", **_PLAN_STEPS)

SQL["report_inventory"] = statement("inventory", f"""
    SELECT report_date, {whole('units')} AS summary_total_stock_qty,
        {real('worth')} AS summary_total_stock_value, low_stock, overstock, {_ALWAYS}
    FROM stock""", **_STOCK_STEPS)

# ---- one period asked for ----


def _one(report: str, period: str, value: str, lists: tuple[str, ...]) -> str:
    """The report's row, or an empty one."""
    shown = ", ".join(f"coalesce({c}, '') AS {c}" for c in lists)
    return f"""SELECT asked.{period}, r.* EXCLUDE ({period})
            REPLACE ({shown}, CAST(coalesce(has_data, 0) AS BIGINT) AS has_data)
        FROM (SELECT '{value}' AS {period}) AS asked
        LEFT JOIN ({SQL[report]}) AS r ON r.{period} = asked.{period}"""


SQL["report_monthly_of_1998_06"] = _one("report_monthly", "month", "1998-06", tuple(_LISTS))
SQL["report_monthly_of_unknown"] = _one("report_monthly", "month", "1901-01", tuple(_LISTS))
SQL["report_plan_fact_of_1998_06"] = _one(
    "report_plan_fact", "month", "1998-06", ("worst_stores_by_plan", "worst_categories_by_plan"))
SQL["report_inventory_of_1998_06_30"] = _one(
    "report_inventory", "report_date", "1998-06-30", ("low_stock", "overstock"))

# ---- narratives ----


def _or_none(expr: str) -> str:
    return f"coalesce({expr}, 'no data')"


SQL["narrative_monthly"] = statement("sales plan_sales", f"""
    SELECT month, {_ALWAYS}, month || ': ' || {money_text('q')} || ' units brought in '
        || {money_text('r')} || ' RUB, of which ' || {money_text('p')}
        || ' RUB are profit. First and last among the stores: ' || {_or_none('ts_first')} || ' and '
        || {_or_none('ls_first')} || '; first among the categories: ' || {_or_none('tc_first')}
        || '. Share of planned revenue: ' || {pct_text('done')} || '.' AS narrative
    FROM monthly""", **_MONTHLY_STEPS)

SQL["narrative_plan_fact"] = statement("sales plan_sales", f"""
    SELECT month, {_ALWAYS}, month || ': ' || {money_text('fr')} || ' RUB were taken where '
        || {money_text('pr')} || ' RUB were planned (' || {pct_text('done')}
        || '); profit stands at ' || {pct_text('done_profit')}
        || ' of its plan. Lowest completion: store ' || ws_first || ', category ' || wc_first
        || '.' AS narrative
    FROM plan""", **_PLAN_STEPS)

SQL["narrative_inventory"] = statement("inventory", f"""
    SELECT report_date, {_ALWAYS}, 'Count of ' || report_date || ': ' || {money_text('worth')}
        || ' RUB lie in ' || {money_text('units')} || ' units. Positions listed as LOW: ' || nl
        || ', as OVERSTOCK: ' || nx || '.' AS narrative
    FROM stock""", **_STOCK_STEPS)


def _facts(*pairs: tuple[str, str]) -> str:
    return "concat_ws(', ', " + ", ".join(f"'{n}=' || {v}" for n, v in pairs) + ")"


_LABEL = "strftime(CAST(month || '-01' AS DATE), '%B %Y')"


def _plan_words(value: str) -> str:
    return (f"(CASE WHEN {value} < 100 THEN 'not met' WHEN {value} = 100 THEN 'met exactly'"
            f" WHEN {value} > 100 THEN 'exceeded' ELSE 'no plan' END)")


def _measure_facts(name: str, plan: str, fact: str, done: str) -> list[tuple[str, str]]:
    return [
        (f"actual {name}", money_text(fact)), (f"planned {name}", money_text(plan)),
        (f"{name} gap", money_text(f"{plan} - {fact}")),
        (f"{name} plan completion", pct_text(done)), (f"{name} plan", _plan_words(done)),
    ]


SQL["facts_monthly"] = statement("sales plan_sales", f"""
    SELECT month, {_ALWAYS}, {_facts(
        ('month', _LABEL), ('revenue', money_text('r')), ('profit', money_text('p')),
        ('units sold', money_text('q')), ('revenue plan completion', pct_text('done')),
        ('profit plan completion', pct_text('done_profit')),
        ('leading stores', _or_none('ts_names')), ('leading store', _or_none('ts_first')),
        ('leading categories', _or_none('tc_names')), ('leading category', _or_none('tc_first')),
        ('weakest stores', _or_none('ls_names')), ('weakest store', _or_none('ls_first')),
        ('weakest categories', _or_none('lc_names')), ('weakest category', _or_none('lc_first')),
    )} AS facts
    FROM monthly""", **_MONTHLY_STEPS)

SQL["facts_plan_fact"] = statement("sales plan_sales", f"""
    SELECT month, {_ALWAYS}, {_facts(
        ('month', _LABEL), *_measure_facts('revenue', 'pr', 'fr', 'done'),
        *_measure_facts('profit', 'pp', 'fp', 'done_profit'),
        ('stores furthest behind', 'ws_names'), ('categories furthest behind', 'wc_names'),
    )} AS facts
    FROM plan""", **_PLAN_STEPS)

SQL["facts_inventory"] = statement("inventory", f"""
    SELECT report_date, {_ALWAYS}, {_facts(
        ('report date', 'report_date'), ('units in stock', money_text('units')),
        ('stock value', money_text('worth')), ('short positions listed', 'nl'),
        ('excess positions listed', 'nx'),
    )} AS facts
    FROM stock""", **_STOCK_STEPS)
