from datetime import date

from shopledger.plans import plan_fact, reports, sales
from shopledger.plans.kpi_mart import retail_kpi_mart, store_monthly_heatmap


def fan_out(make):
    return make(
        sales=[{"revenue": 20, "profit": 8}] * 3, plan_sales=[{"plan_revenue": 100}]
    )


def test_plan_is_counted_once_per_sale_by_default(make, rows):
    tables = fan_out(make)
    for mart in (plan_fact.plan_fact_dashboard, plan_fact.plan_fact_summary,
                 plan_fact.plan_fact_store, plan_fact.plan_fact_category):
        [got] = rows(mart(tables))
        assert (got["plan_revenue"], got["fact_revenue"]) == (300, 60)
        pct = got.get("plan_revenue_pct", got.get("revenue_plan_completion_pct"))
        assert pct == 20.00


def test_plan_once_gives_the_undistorted_figure(make, rows):
    [got] = rows(plan_fact.plan_fact_summary(fan_out(make), plan_once=True))
    assert (got["plan_revenue"], got["plan_revenue_pct"]) == (100, 60.00)


def test_pre_aggregated_marts_have_no_fan_out(make, rows):
    tables = fan_out(make)
    assert rows(plan_fact.category_plan_fact(tables))[0]["plan_revenue"] == 100
    assert rows(plan_fact.plan_fact_trend(tables))[0]["plan_revenue"] == 100
    assert rows(retail_kpi_mart(tables))[0]["plan_revenue"] == 100


def test_plan_without_sales(make, rows):
    [got] = rows(plan_fact.plan_fact_dashboard(make(plan_sales=[{}])))
    assert (got["plan_revenue"], got["fact_revenue"]) == (100, 0)
    assert got["revenue_plan_completion_pct"] == 0.00
    assert got["revenue_variance"] == -100


def test_sale_without_plan(make, rows):
    tables = make(sales=[{"revenue": 50}])
    [trend] = rows(plan_fact.plan_fact_trend(tables))
    assert (trend["plan_revenue"], trend["fact_revenue"]) == (0, 50)
    assert trend["revenue_plan_completion_pct"] is None
    assert rows(plan_fact.plan_fact_dashboard(tables)) == []
    assert rows(plan_fact.category_plan_fact(tables)) == []


def test_zero_plan_has_no_completion_and_ranks_last(make, rows):
    tables = make(
        stores=[{"store_id": s} for s in ("S1", "S2")],
        plan_sales=[{"store_id": "S1", "plan_revenue": 0}, {"store_id": "S2"}],
    )
    worst = rows(reports.worst_stores_by_plan(tables), "position")
    assert [w["store_id"] for w in worst] == ["S2", "S1"]
    assert worst[1]["plan_revenue_pct"] is None


def test_every_margin_guards_against_zero(make, rows):
    tables = make(
        stores=[{"store_area_sqm": 0, "employees_count": 0}],
        sales=[{"revenue": 0, "quantity": 0, "profit": 0}],
    )
    [got] = rows(sales.sales_enriched(tables))
    for column in ("margin_pct", "avg_unit_revenue", "profit_per_unit",
                   "revenue_per_employee", "revenue_per_sqm"):
        assert got[column] is None


def test_calendar_columns(make, rows):
    days = [date(2024, 12, 1), date(2024, 12, 7), date(2024, 12, 30), date(2021, 1, 3)]
    got = {r["sale_date"]: r for r in
           rows(sales.sales_enriched(make(sales=[{"sale_date": d} for d in days])))}
    sunday, saturday, monday, early = (got[d] for d in days)
    assert (sunday["day_of_week_num"], sunday["is_weekend"]) == (0, 1)
    assert (saturday["day_of_week_num"], saturday["is_weekend"]) == (6, 1)
    assert (monday["sale_year"], monday["sale_week"], monday["is_weekend"]) == (2024, 1, 0)
    assert (early["sale_year"], early["sale_week"], early["sale_quarter"]) == (2021, 53, 1)


def test_unknown_store_and_product_keep_the_sale(make, rows):
    tables = make(sales=[{"store_id": "S9", "product_id": "P9"}])
    [got] = rows(sales.sales_enriched(tables))
    assert got["store_name"] is None and got["brand"] is None and got["revenue"] == 20
    [store] = rows(sales.store_performance(tables))
    assert store["region"] is None and store["revenue_per_sqm"] is None


def test_category_is_the_one_on_the_sale(make, rows):
    tables = make(sales=[{"category": "Gifts"}])
    assert rows(sales.sales_enriched(tables))[0]["category"] == "Gifts"
    [group] = rows(sales.category_performance(tables))
    assert (group["category"], group["subcategory"]) == ("Gifts", "Green")


def test_shares_of_a_month(make, rows):
    tables = make(sales=[
        {"category": "A", "revenue": 75}, {"category": "B", "revenue": 25},
        {"category": "A", "revenue": 10, "sale_date": date(2024, 11, 1)},
    ])
    got = {(r["sale_month"], r["category"]): r["revenue_share_pct"]
           for r in rows(sales.category_performance(tables))}
    assert got == {("2024-12", "A"): 75, ("2024-12", "B"): 25, ("2024-11", "A"): 100}


def test_month_text_that_disagrees_with_the_date_stays_apart(make, rows):
    tables = make(sales=[{}, {"sale_month": "2024-12", "sale_date": date(2024, 11, 30)}])
    got = rows(sales.monthly_sales_kpi(tables), "sale_month_num")
    assert [(r["sale_month"], r["sale_month_num"]) for r in got] == [("2024-12", 11), ("2024-12", 12)]


def test_underplan_rank_starts_with_the_largest_shortfall(make, rows):
    tables = make(
        stores=[{"store_id": "S1"}, {"store_id": "S2"}],
        sales=[{"store_id": "S1", "revenue": 50}, {"store_id": "S2", "revenue": 90}],
        plan_sales=[{"store_id": "S1"}, {"store_id": "S2"}],
    )
    got = {r["store_id"]: r for r in rows(store_monthly_heatmap(tables))}
    assert (got["S1"]["underplan_rank"], got["S2"]["underplan_rank"]) == (1, 2)
    assert (got["S1"]["revenue_rank"], got["S2"]["revenue_rank"]) == (2, 1)


def test_months_restrict_every_input(make, rows):
    tables = make(
        sales=[{}, {"sale_date": date(2024, 11, 5)}],
        plan_sales=[{}, {"plan_month": "2024-10"}],
        inventory=[{}, {"inventory_date": date(2024, 9, 30)}],
    )
    got = rows(retail_kpi_mart(tables, months=["2024-12"]))
    assert [r["report_month"] for r in got] == ["2024-12"]
    assert len(rows(retail_kpi_mart(tables))) == 4


def test_ranks_share_ties_and_count_unknown_stores(make, rows):
    stores = [f"S{i}" for i in range(9)]
    tables = make(
        stores=[{"store_id": s} for s in stores[:4]],
        sales=[{"store_id": s, "revenue": 10 + i % 3, "profit": 5, "sale_date": d}
               for i, s in enumerate(stores) for d in (date(2024, 12, 1), date(2024, 11, 1))],
        plan_sales=[{"store_id": s, "plan_revenue": 10 * i} for i, s in enumerate(stores)],
    )
    order = ("report_month", "store_id")
    found = rows(store_monthly_heatmap(tables), *order)
    december = [r for r in found if r["report_month"] == "2024-12"]
    assert len(found) == 18 and december[8]["store_name"] is None
    assert [r["revenue_rank"] for r in december] == [7, 4, 1] * 3
    assert {r["profit_rank"] for r in december} == {1}
    assert [r["underplan_rank"] for r in december] == [9, 8, 7, 6, 5, 4, 3, 2, 1]
