import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.plans import dashboards, narratives, reports
from shopledger.plans.registry import MARTS


@pytest.fixture(scope="module")
def chain(make):
    return make(
        stores=[{"store_id": f"S{i}", "store_name": f"Store {i}",
                 "region": "Volga" if i > 2 else "Central"} for i in range(1, 6)],
        products=[{}, {"product_id": "P2", "brand": "Select", "category": "Cake"}],
        sales=[{"store_id": f"S{i}", "revenue": 10 * min(i, 4), "profit": i} for i in range(1, 6)]
        + [{"product_id": "P2", "category": "Cake", "revenue": 5, "sales_channel": None}],
        plan_sales=[{"store_id": f"S{i}", "plan_revenue": 50, "plan_profit": i} for i in range(1, 4)]
        + [{"plan_month": "2024-10"}],
        inventory=[{"product_id": f"P{i}", "stock_value": i, "stock_status": "LOW"}
                   for i in range(1, 13)] + [{"store_id": "S2", "stock_status": "OVERSTOCK"}],
    )


def test_monthly_report(chain, rows):
    december, october = rows(reports.report_monthly(chain), F.desc("month"))
    assert [s["store_id"] for s in december["top_stores"]] == ["S4", "S5", "S3"]
    assert [s["store_id"] for s in december["low_stores"]] == ["S1", "S2", "S3"]
    assert [c["category"] for c in december["top_categories"]] == ["Tea", "Cake"]
    assert december["kpi"]["sales_count"] == 6 and december["has_data"]
    assert october["kpi"] is None and october["top_stores"] == [] and october["has_data"]
    assert float(october["plan_fact"]["plan_revenue"]) == 100


def test_report_for_one_period(chain, rows):
    [got] = rows(reports.report_monthly(chain, "2024-12"))
    assert got["month"] == "2024-12" and len(got["top_stores"]) == 3
    [nothing] = rows(narratives.narrative_monthly(chain, "2030-01"))
    assert nothing["narrative"] == narratives.NO_REPORT_DATA and not nothing["has_data"]
    [nothing] = rows(narratives.narrative_inventory(chain, "2030-01-31"))
    assert nothing["narrative"] == narratives.NO_REPORT_DATA
    [unknown] = rows(narratives.narrative(chain, "weather"))
    assert unknown["narrative"] == narratives.NO_TEMPLATE
    with pytest.raises(ValueError):
        reports.report_monthly(chain, "December")


def test_plan_fact_report(chain, rows):
    got = rows(reports.report_plan_fact(chain), F.desc("month"))
    assert [r["month"] for r in got] == ["2024-12", "2024-10"]
    assert [s["store_id"] for s in got[0]["worst_stores_by_plan"]] == ["S1", "S2", "S3"]


def test_inventory_report_counts_the_capped_lists(chain, rows):
    [got] = rows(reports.report_inventory(chain, date(2024, 12, 31)))
    assert [p["product_id"] for p in got["low_stock"]][:3] == ["P12", "P11", "P10"]
    assert len(got["low_stock"]) == 10 and len(got["overstock"]) == 1
    [told] = rows(narratives.narrative_inventory(chain))
    assert told["narrative"].endswith("LOW: 10, as OVERSTOCK: 1.")


def test_payload_is_plain_json(chain, rows):
    report = reports.with_payload(reports.report_inventory(chain, "2024-12-31"))
    payload = json.loads(rows(report)[0]["payload"])
    assert payload["report_date"] == "2024-12-31"
    assert payload["overstock"][0]["stock_value"] == 200.0
    assert isinstance(payload["summary"]["total_stock_value"], float)


def plan_story(make, rows, fact, plan=100):
    tables = make(sales=[{"revenue": fact, "profit": 8}],
                  plan_sales=[{"plan_revenue": plan, "plan_profit": 8}])
    facts = rows(narratives.facts_plan_fact(tables))[0]["facts"]
    status = rows(reports.plan_status(tables))[0]["revenue_status"]
    return status, {f["name"]: f["value"] for f in facts}


def test_plan_status_follows_the_numbers(make, rows):
    status, facts = plan_story(make, rows, fact=100)
    assert status == "MET" and facts["revenue plan"] == "met exactly"
    assert facts["revenue plan completion"] == "100%" and facts["revenue gap"] == "0"
    status, facts = plan_story(make, rows, fact=130)
    assert status == "EXCEEDED" and facts["revenue plan"] == "exceeded"
    status, facts = plan_story(make, rows, fact=59)
    assert status == "NOT_MET" and facts["revenue plan completion"] == "59%"
    assert (facts["revenue gap"], facts["profit plan"]) == ("41", "met exactly")
    status, facts = plan_story(make, rows, fact=59, plan=0)
    assert status is None and facts["revenue plan"] == "no plan"
    assert facts["month"] == "December 2024"


def test_monthly_facts(chain, rows):
    facts = {f["name"]: f["value"]
             for f in rows(narratives.facts_monthly(chain, "2024-12"))[0]["facts"]}
    assert facts["leading stores"] == "S4, S5, S3" and facts["weakest category"] == "Cake"
    assert facts["revenue"] == "145" and len(facts) == 14


def test_widgets_with_selectors(chain, rows):
    central = {"region": ["Central"]}
    by_brand = rows(dashboards.profit_by_brand(chain, central), "brand")
    assert [(r["brand"], r["profit"]) for r in by_brand] == [("Daily", 3), ("Select", 8)]
    [tea] = rows(dashboards.revenue_by_category(chain, central | {"category": ["Tea"]}))
    assert tea["revenue"] == 30
    channels = {r["sales_channel"]: r["revenue_share_pct"]
                for r in rows(dashboards.revenue_by_channel(chain))}
    assert channels == {"online": 96.55, None: 3.45}
    regions = rows(dashboards.stock_status_by_region(chain), "stock_status")
    assert [(r["region"], r["stock_status"], r["positions"]) for r in regions] == [
        ("Central", "LOW", 12), ("Central", "OVERSTOCK", 1)]
    [kpi] = rows(dashboards.inventory_kpis(chain, {"stock_status": "LOW"}))
    assert (kpi["low_stock_positions"], kpi["overstock_positions"]) == (12, 0)
    [gap] = rows(dashboards.variance_by_store(chain, {"store_name": ["Store 2"]}))
    assert gap["revenue_variance"] == -30
    with pytest.raises(ValueError, match="no such columns"):
        dashboards.revenue_by_day(chain, {"weather": ["rain"]})


@pytest.mark.parametrize("name", sorted(MARTS))
def test_months_may_be_any_iterable(chain, rows, name):
    listed = rows(MARTS[name](chain, ["2024-12", "2024-10"]))
    once = rows(MARTS[name](chain, (m for m in ("2024-12", "2024-10"))))
    key = lambda r: sorted(map(str, r.items()))
    assert sorted(once, key=key) == sorted(listed, key=key)
    with pytest.raises(ValueError):
        MARTS[name](chain, iter(["December"]))


def test_selectors_may_be_iterators(chain, rows):
    chosen = {"region": iter(["Volga"]), "sale_month": iter(["2024-12"])}
    [row] = rows(dashboards.revenue_by_category(chain, chosen))
    assert row == {"category": "Tea", "revenue": 110}


def test_store_charts_and_plan_tiles(chain, rows):
    assert rows(dashboards.revenue_per_employee_by_store(chain, {"region": "Central"}), "store_name") == [
        {"store_name": "Store 1", "revenue_per_employee": 1.5},
        {"store_name": "Store 2", "revenue_per_employee": 2.0}]
    assert rows(dashboards.revenue_per_sqm_by_store(chain, {"store_name": "Store 5"}))[0]["revenue_per_sqm"] == 0.4
    assert rows(dashboards.profit_by_store(chain, {"store_format": "none"})) == []
    assert rows(dashboards.plan_fact_kpis(chain, {"plan_month": "2024-10"})) == [
        {"plan_revenue": 100, "fact_revenue": 0, "revenue_plan_completion_pct": 0}]
    assert rows(dashboards.plan_fact_kpis(chain, {"plan_month": "2023-10"}))[0]["plan_revenue"] is None
