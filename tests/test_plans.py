"""What the physical plans must and must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql
from check import compare
from shopledger.operators.aligning import Side, align
from shopledger.plans import dashboards, fx, kpi_mart, product_classes, reports, sales
from shopledger.plans.plan_fact import plan_fact_trend
from shopledger.plans.registry import MARTS
from shopledger.plans.sales import monthly_kpi, monthly_sales_kpi
from shopledger.schemas import ENTITIES
from shopledger.sources.star_schema import StarSchemaTables

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def executed(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, make, tmp_path_factory):
    """Core tables as Parquet files."""
    root = tmp_path_factory.mktemp("core")
    tables = make(sales=[{}, {"category": "Cake"}], plan_sales=[{}], inventory=[{}],
                  currency_rates=[{}])
    for name, rows in tables.items():
        rows.write.parquet(str(root / name))
    return {n: spark.read.schema(ENTITIES[n].core).parquet(str(root / n)) for n in tables}


def test_month_totals_join_nothing(stored):
    plan = executed(monthly_sales_kpi(stored))
    assert "Join" not in plan and plan.count("FileScan") == 1


def test_month_reaches_the_scan_of_every_input(stored):
    plan = executed(plan_fact_trend(stored, months=["2024-12"]))
    assert plan.count("FileScan") == 2 and plan.count("EqualTo(") == 2


def test_fx_reads_nothing_after_the_last_month(stored):
    result = fx.fx_risk_metrics(stored, months=["2024-10", "2024-11"])
    plan = result._jdf.queryExecution().sparkPlan().toString()
    assert "LessThanOrEqual(sale_month,2024-11)" in plan and "LessThan(rate_date,2024-12-01)" in plan


def test_chosen_months_reach_the_scans_of_a_widget(stored):
    plan = executed(dashboards.executive_summary(stored, {"sale_month": ["2024-12"]}))
    assert "EqualTo(sale_month,2024-12)" in plan and "EqualTo(plan_month,2024-12)" in plan
    assert "GreaterThanOrEqual(inventory_date,2024-12-01)" in plan


def test_chosen_stores_and_products_cut_the_facts_first(stored):
    chosen = {"region": "Central", "brand": "Daily"}
    logical = dashboards.revenue_by_category(stored, chosen)._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Join LeftSemi") == 2
    assert logical.index("Aggregate") < logical.index("Join LeftSemi")


def test_only_needed_columns_are_read(stored):
    plan = executed(monthly_kpi(stored))
    assert "ReadSchema: struct<sale_month:string,quantity:int,revenue:decimal(14,2)" in plan
    assert "product_id" not in plan


def test_alignment_is_one_shuffle_without_joins(stored):
    plan = executed(plan_fact_trend(stored))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def scans(plan, table):
    return len(re.findall(rf"FileScan parquet .*/{table}[\],]", plan))


@pytest.mark.parametrize("query, tables", [
    (kpi_mart.store_monthly_heatmap, ("sales", "plan_sales", "inventory", "stores")),
    (kpi_mart.dashboard_summary, ("sales", "plan_sales", "inventory")),
    (sales.category_performance, ("sales", "products")),
    (product_classes.abc_xyz_analysis, ("sales", "products")),
    (reports.report_monthly, ("sales", "plan_sales")),
    (reports.report_plan_fact, ("sales", "plan_sales")),
])
def test_each_table_is_scanned_once(spark, stored, query, tables):
    # no join may look at sizes here: a broadcast would hide a second shuffle
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(query(stored))
        assert [scans(plan, t) for t in tables] == [1] * len(tables)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("mart", [sales.category_performance, kpi_mart.retail_kpi_mart])
def test_facts_are_summed_before_products_join(spark, stored, mart):
    """Below a join on the product there is an aggregate, with its map-side half."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        logical = mart(stored)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = logical.split("\n")
    [at] = [i for i, line in enumerate(lines) if "Join LeftOuter, (product_id" in line]
    assert "Aggregate [" in "\n".join(lines[at + 1 : at + 4])


def test_alignment_sums_beyond_a_long(spark):
    rows = spark.range(20_000).select(
        F.lit("k").alias("k"), F.lit("9999999999999999.99").cast("decimal(18,2)").alias("x"))
    both = {"a": Side(rows, ["k"], {"x": "x"}), "b": Side(rows.selectExpr("k", "-x as x"), ["k"], {"y": "x"})}
    [row] = align(["k"], both).collect()
    assert str(row.x) == "199999999999999999800.00" and row.y == -row.x and row.a_rows == 20_000


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_alignment_keeps_decimals_exact(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        big = spark.range(3).select(
            F.lit("k").alias("k"), F.lit("999999999999.99").cast("decimal(14,2)").alias("x"))
        [row] = align(["k"], {"a": Side(big, ["k"], {"x": "x"})}).collect()
        assert str(row.x) == "2999999999999.97" and row.a_rows == 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@needs_data
def test_no_mart_multiplies_rows_or_runs_python(spark):
    tables = StarSchemaTables(spark, DATA)
    for name, mart in MARTS.items():
        plan = executed(mart(tables))
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert unwanted not in plan, name
        assert plan.count("FileScan parquet [l_orderkey") <= 1, name


@needs_data
def test_unread_channel_costs_no_join(spark):
    plan = executed(StarSchemaTables(spark, DATA)["sales"].select("revenue"))
    assert "o_orderkey" not in plan


# ---- every query against its SQL statement ----

@needs_data
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_statement(spark, name):
    assert compare(spark, DATA, name, oracle_sql()[name]) is None
