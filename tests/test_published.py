import os
from datetime import date

import pytest
from pyspark.errors import PySparkException

from shopledger.plans import published
from shopledger.plans.registry import MARTS

NAMES = ("monthly_kpi", "sales_fx_monthly", "report_monthly", "report_inventory", "abc_xyz_analysis",
         "inventory_summary")


def tables(make, december="20", store="S1"):
    return make(
        sales=[dict(sale_date=date(2024, m, 2), revenue=r, store_id=store, sale_id=f"T{m}")
               for m, r in ((10, "20"), (11, "30"), (12, december))],
        currency_rates=[dict(rate_date=date(2024, m, 1), rate_to_rub=str(100 + m)) for m in (10, 11, 12)],
        inventory=[dict(inventory_date=date(2024, 11, 30)), dict(inventory_date=date(2024, 12, 31), stock_qty=7)],
        plan_sales=[{}])


def content(spark, root, name):
    found = spark.read.parquet(f"{root}/{name}").filter("live").drop("stored_month", "live")
    return sorted(map(str, found.collect()))


def folders(root, name):
    return {f: os.stat(f"{root}/{name}/{f}").st_mtime_ns for f in os.listdir(f"{root}/{name}") if "=" in f}


@pytest.fixture(scope="module")
def stored(spark, make, tmp_path_factory):
    """A first build, then a refresh after a merge of December."""
    root, whole = (str(tmp_path_factory.mktemp(n)) for n in ("marts", "whole"))
    published.refresh(tables(make), root, names=NAMES)
    before = {name: folders(root, name) for name in NAMES}
    published.refresh(tables(make, december="90"), root, ["2024-12"], names=NAMES)
    published.refresh(tables(make, december="90"), whole, names=NAMES)
    return root, whole, before


def test_a_refresh_equals_a_full_build(spark, stored):
    root, whole, _ = stored
    for name in NAMES:
        assert content(spark, root, name) == content(spark, whole, name), name


def test_a_refresh_rewrites_touched_months_only(stored):
    root, _, before = stored
    for name in ("monthly_kpi", "sales_fx_monthly", "report_monthly", "report_inventory"):
        after = folders(root, name)
        changed = {f for f in after if after[f] != before[name].get(f)}
        assert changed == {"stored_month=2024-12"}, name
    assert set(before["abc_xyz_analysis"]) == {"stored_month=all"}


def test_another_session_asks_by_sql(spark, stored, rows):
    root, _, _ = stored
    made = published.register(spark, root, "retail_test", NAMES + ("store_monthly",))
    assert made == list(NAMES)
    other = spark.newSession()
    other.sql("USE retail_test")
    assert [r.revenue for r in other.sql("SELECT revenue FROM retail_test.monthly_kpi ORDER BY sale_month").collect()] == [20, 30, 90]
    [december] = rows(other.sql("SELECT * FROM report_monthly('2024-12')"))
    assert december["kpi"]["revenue"] == 90 and december["has_data"] and december["plan_fact"]["plan_revenue"] == 100
    [unknown] = rows(other.sql("SELECT * FROM report_monthly('1901-01')"))
    assert (unknown["month"], unknown["has_data"], unknown["kpi"], unknown["top_stores"]) == ("1901-01", False, None, [])
    [stock] = rows(other.sql("SELECT * FROM report_inventory('2024-12-31')"))
    assert stock["summary"]["total_stock_qty"] == 7 and stock["report_date"] == date(2024, 12, 31)
    assert rows(other.sql("SELECT sum(revenue) AS r FROM monthly_kpi('2024-11')")) == [{"r": 30}]
    with pytest.raises(PySparkException, match="month must be written YYYY-MM"):
        other.sql("SELECT * FROM report_monthly('June')").collect()
    plan = other.sql("SELECT * FROM monthly_kpi('2024-11')")._jdf.queryExecution().executedPlan().toString()
    assert "stored_month" in plan and "2024-11" in plan.split("PartitionFilters")[1].split("]")[0]
    # a month that has lost its rows, and one that is new, are seen after the next registration
    for name in made:
        other.sql(f"SELECT count(*) FROM retail_test.{name}").collect()
    spark.sql("DROP DATABASE retail_test CASCADE")


def test_a_month_that_lost_its_rows(spark, make, tmp_path):
    root = str(tmp_path)
    published.refresh(tables(make), root, names=("monthly_kpi",))
    moved = tables(make) | {"sales": tables(make)["sales"].filter("sale_month <> '2024-12'")}
    published.refresh(moved, root, ["2024-12"], names=("monthly_kpi",))
    assert len(content(spark, root, "monthly_kpi")) == 2


def test_everything_that_is_stored_has_a_way_to_be_built():
    assert set(MARTS) < set(published.STORED) and len(published.STORED) == len(MARTS) + 9
    assert published.touched_months([("sales", "2024-12", 1, True, None), ("stores", "all", 1, True, None)]) == ("2024-12",)
