from datetime import date

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from shopledger.functions.labels import in_russian
from shopledger.operators.ranking import with_ranks
from shopledger.operators.running_total import running_total
from shopledger.operators.value_ranges import range_of
from shopledger.plans import fx
from shopledger.plans.inventory import inventory_risks, inventory_turnover
from shopledger.plans.kpi_mart import dashboard_summary, retail_kpi_mart
from shopledger.plans.product_classes import abc_xyz_analysis


def test_quantity_turnover_is_an_integer_division(make, rows):
    tables = make(sales=[{"quantity": 7}], inventory=[{"stock_qty": 2}])
    assert rows(inventory_turnover(tables))[0]["qty_turnover_ratio"] == 3
    exact = inventory_turnover(tables, exact_quantity_ratio=True)
    assert rows(exact)[0]["qty_turnover_ratio"] == 3.5


@pytest.mark.parametrize("stock, sale, status", [
    ({"stock_qty": 5}, None, "NO_SALES"),
    (None, {}, "NO_STOCK"),
    ({"stock_qty": 0}, {}, "NO_STOCK"),
    ({"days_of_cover": "6.99"}, {}, "SHORTAGE_RISK"),
    ({"days_of_cover": "45.01"}, {}, "EXCESS_RISK"),
    ({"days_of_cover": "45"}, {}, "NORMAL"),
])
def test_turnover_status(make, rows, stock, sale, status):
    tables = make(sales=[] if sale is None else [sale], inventory=[] if stock is None else [stock])
    assert rows(inventory_turnover(tables))[0]["turnover_status"] == status


def test_stock_is_summed_behind_its_one_shuffle(spark, make, rows):
    counts = [dict(inventory_date=date(2024, 12, d), stock_qty=q, stock_value=str(q * 10), days_of_cover=str(q),
                   stock_status=s) for d, q, s in ((10, 5, "LOW"), (20, 50, "OVERSTOCK"), (31, 20, "OK"))]
    turned = inventory_turnover(make(inventory=counts))
    [got] = rows(turned)
    assert (got["stock_qty"], got["stock_value"], got["stock_status"]) == (75, 750, "OVERSTOCK")
    assert got["avg_days_of_cover"] == 25
    # comparing texts sorts; before the shuffle this would be one more sort of all positions
    below = turned._jdf.queryExecution().sparkPlan().toString().split("partial_max(stock_status")[1]
    assert "RepartitionByExpression" in below or "REPARTITION_BY_COL" in below


def test_status_of_a_month_is_the_last_in_alphabet(make, rows):
    tables = make(inventory=[
        {"stock_status": "LOW", "inventory_date": date(2024, 12, 15)}, {"stock_status": "OK"},
    ])
    assert rows(inventory_turnover(tables))[0]["stock_status"] == "OK"


def test_product_sold_under_two_categories_keeps_two_rows(make, rows):
    tables = make(sales=[{"category": "A"}, {"category": "B"}], inventory=[{}])
    got = rows(inventory_turnover(tables), "category")
    assert [(r["category"], r["stock_qty"]) for r in got] == [("A", 20), ("B", 20)]


def test_two_counts_in_a_month_give_two_summary_rows(make, rows):
    tables = make(sales=[{}], inventory=[{}, {"inventory_date": date(2024, 12, 15)}])
    got = rows(dashboard_summary(tables), "latest_inventory_date")
    assert [r["latest_inventory_date"].day for r in got] == [15, 31]
    assert {r["sale_month"] for r in got} == {"2024-12"}


def test_stock_of_unknown_product_has_its_own_row(make, rows):
    tables = make(sales=[{}], inventory=[{"product_id": "P9"}])
    got = rows(retail_kpi_mart(tables), "category")
    assert [r["category"] for r in got] == [None, "Tea"]
    assert [(r["stock_qty"], r["fact_revenue"]) for r in got] == [(20, 0), (0, 20)]


@pytest.mark.parametrize("sale, stock, plan, status", [
    ({}, {"stock_status": "LOW"}, {}, "LOST_SALES_RISK"),
    (None, {"stock_status": "LOW"}, {}, "BELOW_PLAN"),
    ({}, {"stock_status": "OVERSTOCK"}, {}, "OVERSTOCK"),
    ({}, {}, {}, "BELOW_PLAN"),
    ({"revenue": 100}, {}, {}, "NORMAL"),
])
def test_management_status(make, rows, sale, stock, plan, status):
    tables = make(
        sales=[] if sale is None else [sale], inventory=[stock], plan_sales=[plan],
    )
    assert rows(retail_kpi_mart(tables))[0]["management_status"] == status


def test_status_codes_have_russian_wording(make, rows):
    got = rows(in_russian(retail_kpi_mart(make(sales=[{}]))))
    assert got[0]["management_status"] == "Норма"


def test_wide_average_is_rounded_once(make, rows, spark):
    tables = make()
    cover = F.when(F.col("id") < 10000, "1.01").otherwise("1.00").cast("decimal(10,2)")
    tables["inventory"] = spark.range(20001).select(
        F.lit(date(2024, 12, 31)).alias("inventory_date"), F.lit("S1").alias("store_id"),
        F.concat(F.lit("P"), "id").alias("product_id"), F.lit(1).alias("stock_qty"),
        F.lit(1).cast("decimal(14,2)").alias("stock_value"), F.lit(1).alias("reorder_point"),
        cover.alias("days_of_cover"), F.lit("OK").alias("stock_status"),
    )
    assert rows(retail_kpi_mart(tables))[0]["avg_days_of_cover"] == 1.00


def test_inventory_flags(make, rows):
    [got] = rows(inventory_risks(make(inventory=[{"stock_status": "LOW", "stock_qty": 3}])))
    assert (got["is_low_stock"], got["is_overstock"], got["stock_vs_reorder_qty"]) == (1, 0, -12)


# ---- exchange rates ----

def rates(*values, start=1):
    return [{"rate_date": date(2024, m, 10), "rate_to_rub": v}
            for m, v in enumerate(values, start)]


def monthly_sales(*months):
    return [{"sale_date": date(2024, m, 5)} for m in months]


def test_first_month_has_no_pressure(make, rows):
    tables = make(sales=monthly_sales(1), currency_rates=rates(100))
    [got] = rows(fx.fx_risk_metrics(tables))
    assert got["avg_rate_mom_pct"] is None
    assert got["estimated_cost_pressure_rub"] == 0
    assert got["fx_risk_status"] == "STABLE"


def test_change_is_against_the_previous_month_present(make, rows):
    tables = make(sales=monthly_sales(1, 3), currency_rates=rates(100, 500, 110))
    got = rows(fx.sales_fx_monthly(tables), "report_month")
    assert got[1]["report_month"] == "2024-03" and got[1]["avg_rate_mom_pct"] == 10


@pytest.mark.parametrize("rate, status", [
    ("105", "HIGH"), ("102", "MODERATE"), ("98", "EASING"), ("101.99", "STABLE"),
])
def test_risk_thresholds(make, rows, rate, status):
    tables = make(sales=monthly_sales(1, 2), currency_rates=rates("100", rate))
    assert rows(fx.fx_risk_metrics(tables), "report_month")[1]["fx_risk_status"] == status


def test_months_do_not_cut_off_the_comparison(make, rows):
    tables = make(sales=monthly_sales(1, 2), currency_rates=rates(100, 110))
    [got] = rows(fx.sales_fx_monthly(tables, months=["2024-02"]))
    assert got["avg_rate_mom_pct"] == 10


def test_rate_statistics(make, rows):
    days = [(1, "100"), (2, "130"), (3, "90"), (4, "120")]
    tables = make(currency_rates=[
        {"rate_date": date(2024, 1, d), "rate_to_rub": r} for d, r in days])
    [got] = rows(fx.currency_rates_monthly(tables))
    assert (got["first_rate_to_rub"], got["last_rate_to_rub"]) == (100, 120)
    assert (got["min_rate_to_rub"], got["max_rate_to_rub"]) == (90, 130)
    assert got["avg_rate_to_rub"] == 110 and got["monthly_change_pct"] == 20
    assert got["monthly_volatility_pct"] == 36.36 and got["observations"] == 4


# ---- product classes ----

def products(*revenues):
    return [{"product_id": f"P{i}", "revenue": r} for i, r in enumerate(revenues)]


@pytest.mark.parametrize("revenues, classes", [
    ((80, 15, 5), "ABC"), ((81, 14, 5), "BBC"), ((50, 50), "AC"),
])
def test_abc_boundaries(make, rows, revenues, classes):
    got = rows(abc_xyz_analysis(make(sales=products(*revenues))), "product_id")
    assert "".join(r["abc_class"] for r in got) == classes
    assert got[-1]["cumulative_revenue_share_pct"] == 100


@pytest.mark.parametrize("demand, xyz, cv", [
    ((5,), "X", 0.0), ((100, 100, 100), "X", 0.0), ((80, 100, 120), "Y", 16.33),
    ((10, 100, 190), "Z", 73.48), ((0, 0), "Z", None),
    ((9, 11), "X", 10.0), ((3, 5), "Y", 25.0),
])
def test_xyz_classes(make, rows, demand, xyz, cv):
    tables = make(sales=[
        {"sale_date": date(2024, m, 1), "quantity": q} for m, q in enumerate(demand, 1)])
    [got] = rows(abc_xyz_analysis(tables))
    assert (got["xyz_class"], got["demand_cv_pct"]) == (xyz, cv)
    assert got["active_months"] == len(demand)


def test_running_total_equals_the_plain_window(spark):
    # a third of all values are equal
    data = [(i, 50 if i % 3 == 0 else (i * 7919) % 1000) for i in range(3000)]
    frame = spark.createDataFrame(data, "id int, amount long").repartition(5)
    got = running_total(frame, "amount", [F.asc("id")], "so_far", "all")
    total, expected = 0, {}
    for i, amount in sorted(data, key=lambda r: (-r[1], r[0])):
        total += amount
        expected[i] = total
    assert {r.id: (r.so_far, r["all"]) for r in got.collect()} == {
        i: (so_far, total) for i, so_far in expected.items()}


def test_ranks_equal_the_plain_window(spark):
    data = [(i % 2, i, None if i % 50 == 0 else (i * 7919) % 400 - 200) for i in range(2000)]
    frame = spark.createDataFrame(data, "part int, id int, amount int").repartition(5)
    got = with_ranks(frame, "part", {"up": F.col("amount"), "down": -F.col("amount")})
    plain = frame.withColumns({
        "up": F.rank().over(Window.partitionBy("part").orderBy("amount")),
        "down": F.rank().over(Window.partitionBy("part").orderBy(-F.col("amount"))),
    })
    assert sorted(map(tuple, got.select("id", "up", "down").collect())) == sorted(
        map(tuple, plain.select("id", "up", "down").collect()))


def test_ranges_never_fall(spark):
    values = sorted([0, 0.01, -0.01, 1, 1.01, 99.99, 100, 1e14, -1e14, 12345.67, 12345.68, -3, 1e9])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select(
        "v", range_of(F.col("v").cast("decimal(24,2)")).alias("r")).orderBy("v").collect()
    assert [r.r for r in rows] == sorted(r.r for r in rows)
