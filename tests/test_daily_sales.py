from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.operators import sketches
from shopledger.plans import daily_sales, sales
from shopledger.sources.monthly import read_months, replace_months
from shopledger.sources.star_schema import StarSchemaTables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return StarSchemaTables(spark, SF)


def test_sketches_add_up(spark):
    numbers = spark.range(120_000).select("id", (F.col("id") % 7).alias("day"))
    daily = numbers.unionAll(numbers.filter("id % 2 = 0")).groupBy("day").agg(sketches.distinct_sketch("id").alias("s"))
    whole = daily.agg(sketches.estimate(sketches.merged("s")).alias("n")).first().n
    assert abs(whole / 120_000 - 1) < 4 * sketches.standard_error()
    few = spark.range(1000).agg(sketches.estimate(sketches.distinct_sketch("id")).alias("n")).first().n
    assert few == 1000
    none = spark.createDataFrame([(None,)], "x string").agg(sketches.estimate(sketches.distinct_sketch("x")).alias("n"))
    assert none.first().n == 0


def test_months_folded_from_days_equal_the_mart(tables, rows):
    got = rows(daily_sales.monthly_sales_kpi_sketched(tables), "sale_month")
    exact = rows(sales.monthly_sales_kpi(tables), "sale_month")
    off = [abs(a["active_products"] - b["active_products"]) / b["active_products"] for a, b in zip(got, exact)]
    assert max(off) <= 4 * sketches.standard_error()
    drop = lambda r: {k: v for k, v in r.items() if k != "active_products"}
    assert [drop(r) for r in got] == [drop(r) for r in exact]


def test_queries_count_many_values_exactly(spark, make, rows):
    n = 40_000
    text = lambda letter: F.concat(F.lit(letter), F.col("id").cast("string"))
    [sale] = make(sales=[{}])["sales"].collect()
    copies = spark.range(n).select(*(
        (text("S") if f == "store_id" else text("P") if f == "product_id" else F.lit(sale[f])).alias(f)
        for f in sale.asDict()))
    one_store = copies.withColumn("store_id", F.lit("S0"))
    one_product = copies.withColumn("product_id", F.lit("P1"))
    tables = make()
    counted = [
        (daily_sales.monthly_sales_kpi_sketched, copies, {"active_stores": n, "active_products": n}),
        (daily_sales.store_performance_sketched, one_store, {"active_products": n}),
        (daily_sales.category_stores_sketched, one_product, {"active_stores": n}),
    ]
    for query, sales_rows, expected in counted:
        [got] = rows(query(tables | {"sales": sales_rows}))
        assert {c: got[c] for c in expected} == expected and got["sales_rows"] == n


def test_any_span_of_days(tables, rows):
    first, last = date(1996, 3, 10), date(1996, 9, 5)
    days = daily_sales.by_store(tables, ["1996-%02d" % m for m in range(1, 13)])
    [got] = rows(daily_sales.span_kpi(days, first, last))
    [exact] = rows(tables["sales"].filter(F.col("sale_date").between(first, last)).agg(
        F.count("*").alias("sales_rows"), F.count_distinct("store_id").alias("active_stores"),
        F.count_distinct("product_id").alias("active_products"), F.sum("revenue").alias("revenue")))
    assert got["sales_rows"] == exact["sales_rows"] and got["active_stores"] == exact["active_stores"]
    assert got["revenue"] == exact["revenue"]
    assert abs(got["active_products"] / exact["active_products"] - 1) < 4 * sketches.standard_error()


def test_stored_days_are_replaced_by_month(spark, make, rows, tmp_path):
    root = str(tmp_path)
    old = make(sales=[dict(sale_date=date(2024, 11, 30), product_id="P2"), dict(sale_date=date(2024, 12, 1)),
                      dict(sale_date=date(2024, 10, 1))])
    daily_sales.store(old, root)
    # the sale of November moves to December; October isn't named and stays as it is
    new = make(sales=[dict(sale_date=date(2024, 12, 1)), dict(sale_date=date(2024, 12, 2), product_id="P2"),
                      dict(sale_date=date(2024, 10, 1), revenue="999")])
    daily_sales.store(new, root, ["2024-11", "2024-12"])
    days = daily_sales.stored(spark, root)
    got = rows(daily_sales.monthly_kpi(days["sales_daily_by_store"]), "sale_month")
    assert [(r["sale_month"], r["sales_rows"], r["active_products"], r["revenue"]) for r in got] == [
        ("2024-10", 1, 1, 20), ("2024-12", 2, 2, 40)]
    by_category = daily_sales.category_kpi(days["sales_daily_by_product"], new, ["2024-12"])
    assert sum(r["sales_rows"] for r in rows(by_category)) == 2


def test_months_read_the_days_only(spark, tables, tmp_path):
    daily_sales.store(tables, str(tmp_path), ["1998-06"])
    days = daily_sales.stored(spark, str(tmp_path))
    plan = daily_sales.monthly_kpi(days["sales_daily_by_store"], ["1998-06"])._jdf.queryExecution().toString()
    assert "Expand" not in plan and "lineitem" not in plan and "PartitionFilters: [" in plan


def test_whole_tables_are_replaced_too(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = lambda *data: spark.createDataFrame(list(data), "n int, month string")
    replace_months(frame((1, "2024-01"), (2, "2024-02")), path, "month", None)
    replace_months(frame((3, "2024-02")), path, "month", ("2024-01", "2024-02"))
    assert rows(read_months(spark, path, "n int, month string")) == [{"n": 3, "month": "2024-02"}]
    replace_months(frame((4, "2024-03")), path, "month", None)
    assert rows(read_months(spark, path, "n int, month string")) == [{"n": 4, "month": "2024-03"}]
