import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.functions.parsing import (
    COLUMN_STYLES, column_style, read_day, read_moment, style_reader, styled_day, styled_moment,
)
from shopledger.operators import cleaning, quality
from shopledger.operators.quality import QualityError
from shopledger.plans import upkeep
from shopledger.sources.star_schema import StarSchemaTables
from test_cleaning import SALE


@pytest.mark.parametrize("values, style", [
    (["05.12.2024", "13.12.2024"], "d.M.yyyy"), (["05.12.2024", "12.13.2024"], "M.d.yyyy"),
    (["05.12.2024"], "d.M.yyyy"), (["05/12/2024"], "M/d/yyyy"), (["05/12/2024", "31/12/2024"], "d/M/yyyy"),
    (["2024-12-05 10:00", "x", None], "yyyy-M-d"), (["20241205"], "yyyyMMdd"), (["5-12-2024"], "d-M-yyyy"),
    (["2024-01-02", "03.01.2024", "04.01.2024"], "d.M.yyyy"), (["soon", None], None), ([], None),
])
def test_a_column_settles_its_format(spark, values, style):
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    assert frame.agg(column_style("x").alias("s")).first().s == style


@pytest.mark.parametrize("text, style, expected", [
    ("05.12.2024", "d.M.yyyy", "2024-12-05"), ("05.12.2024", "M.d.yyyy", "2024-05-12"),
    ("05.12.2024 7:30", "M.d.yyyy", "2024-05-12"), ("2024-12-05", "d.M.yyyy", None), ("31/12/2024", "M/d/yyyy", None),
])
def test_days_follow_their_column(value, text, style, expected):
    assert value(styled_day(F.col("x"), F.lit(style)).cast("string"), "x string", text) == expected


def test_moments_follow_their_column(value):
    read = styled_moment(F.col("x"), F.lit("M.d.yyyy")).cast("string")
    assert value(read, "x string", "05.12.2024 7:30") == "2024-05-12 07:30:00"
    assert value(read, "x string", "05.12.2024") == "2024-05-12 00:00:00"
    assert value(styled_day(F.col("x"), F.lit(None).cast("string")), "x string", "2024-01-01") is None


def test_every_style_has_a_pattern_that_reads_it(value):
    for style in COLUMN_STYLES:
        text = value(F.date_format(F.lit(date(2024, 12, 31)), style), "x int", 0)
        assert value(styled_day(F.lit(text), F.lit(style)), "x int", 0) == date(2024, 12, 31)


def test_cleaning_reads_a_column_in_one_format(text_rows, rows):
    days = ["05.12.2024", "12.05.2024", "12.31.2024", "2024-12-01", "31.12.2024", "12.30.2024"]
    landed = text_rows("sales", [SALE | {"sale_id": str(i), "sale_date": d} for i, d in enumerate(days)])
    got = {r["sale_id"]: str(r["sale_date"]) for r in rows(cleaning.clean("sales", landed, dates="column"))}
    assert got == {"0": "2024-05-12", "1": "2024-12-05", "2": "2024-12-31", "5": "2024-12-30"}
    each = {r["sale_id"]: str(r["sale_date"]) for r in rows(cleaning.clean("sales", landed))}
    assert each == {"0": "2024-12-05", "1": "2024-05-12", "3": "2024-12-01", "4": "2024-12-31"}
    with pytest.raises(ValueError):
        cleaning.clean("sales", landed, dates="guess")


def test_each_load_settles_its_own_format(text_rows, rows):
    landed = text_rows("sales", [
        SALE | {"sale_id": str(i), "sale_date": d} for i, d in
        enumerate(["05.12.2024", "31.12.2024", "05.12.2024", "12.31.2024"])
    ]).withColumn("load", F.when(F.col("sale_id") < 2, "a").otherwise("b"))
    got = rows(cleaning.clean("sales", landed, per=["load"], dates="column"), "sale_id")
    assert [(r["load"], str(r["sale_date"])) for r in got] == [
        ("a", "2024-12-05"), ("a", "2024-12-31"), ("b", "2024-05-12"), ("b", "2024-12-31")]


def test_empty_table_by_column(text_rows):
    assert cleaning.clean("sales", text_rows("sales", []), dates="column").collect() == []


def test_each_day_is_tried_once_in_every_format(text_rows):
    landed = text_rows("sales", [SALE | {"sale_id": str(i)} for i in range(5)])
    plan = cleaning.date_styles("sales", landed)._jdf.queryExecution().optimizedPlan().toString()
    # rows are only counted by day; what tries formats stands above that
    assert "gettimestamp" in plan.split("Aggregate [_column")[0] and "gettimestamp" not in plan.split("Aggregate [_column")[1]


def test_days_written_otherwise_are_not_tried(spark):
    frame = spark.createDataFrame([("31/12/2024",)], "x string")
    plan = frame.select(styled_day("x", F.lit("d.M.yyyy")))._jdf.queryExecution().analyzed().toString()
    assert r"^\d+[.]\d+[.]\d+$" in plan


def test_one_step_reads_as_the_formats_do(spark):
    days = ["05.12.2024", "5.12.2024", "31.12.2024", "12.31.2024", "005.0012.2024", "0.1.2024", "30.2.2024",
            "29.2.2024", "5.12.24", "5.12.12024", "5.12.0000", "1.2.0999", "2024.12.5", "5.12", "5.12.2024.1",
            "0" * 17 + "5.12.2024", "0" * 18 + "5.12.2024", "0" * 19 + "5.12.2024", "1.1.2024x", "x1.1.2024", "", " ", "."]
    written = [d.replace(".", m) for d in days for m in "./-"] + [
        "2024-12-5", "2024/12/5", "20241205", "20241332", "2024125", "120241205", "00000101"]
    texts = [day + clock for day in written for clock in (
        "", " ", " 7:30", "T07:30:15", "  23:59:59.123456", " 24:00", " 7", "\n", " 7:30\n", "\n7:30", "\t")]
    frame = spark.createDataFrame([(t, s) for t in [*texts, None] for s in [*COLUMN_STYLES, None]], "x string, s string")
    read = frame.withColumn("r", style_reader(F.col("s"))).select(
        "x", "s", styled_day("x", F.col("s")).alias("d"), read_day("x", F.col("r")).alias("day"),
        styled_moment("x", F.col("s")).alias("m"), read_moment("x", F.col("r")).alias("moment"))
    assert read.filter("not d <=> day or not m <=> moment").collect() == []
    assert read.filter("d is not null").count() > 300 and read.filter("m is null and d is not null").count() > 30


@pytest.mark.parametrize("name", ["clean_sales_of_mixed_dates", "clean_sales"])
def test_generated_methods_are_short_enough_to_be_compiled(spark, name):
    from __spark_entry__ import queries

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        text = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) > 3 and max(sizes) < 8000  # the JVM leaves longer ones to its interpreter


@pytest.mark.parametrize("query, derived", [
    (upkeep.clean_sales_of_mixed_dates, "round("), (upkeep.quality_check_of_numbers, "round("),
    (lambda t: upkeep.cleaned("sales", t), "round("), (lambda t: upkeep.cleaned("inventory", t), "15.9")])
def test_derived_texts_are_not_shuffled(spark, query, derived):
    plan = query(StarSchemaTables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    *above, below = plan.split("Window [")
    assert "l_extendedprice" in below and derived not in below and derived in "".join(above)


def test_cleaned_numbers_are_checked_in_one_pass(spark):
    tables = StarSchemaTables(spark, "/root/testdata/sf0.001")
    plan = upkeep.quality_check_of_numbers(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


# ---- numbers too large for their column ----

def test_a_number_too_large_is_not_a_missing_one(text_rows, rows):
    landed = text_rows("sales", [
        SALE, SALE | {"sale_id": "2", "revenue": "1e12", "profit": None}, SALE | {"sale_id": "3", "quantity": "3000000000"},
        SALE | {"sale_id": "4", "discount_rate": "1000"}])
    cleaned = cleaning.clean("sales", landed, overflow=True)
    assert {r["sale_id"]: r["overflowed_columns"] for r in rows(cleaned)} == {
        "1": [], "2": ["revenue"], "3": ["quantity"], "4": ["discount_rate"]}
    found = {(r["rule"], r["columns"], r["bad_rows"]) for r in rows(quality.violations("sales", cleaned))}
    assert found == {("not_null", "profit", 1), ("precision", "revenue", 1), ("precision", "quantity", 1),
                     ("precision", "discount_rate", 1)}
    with pytest.raises(QualityError, match=r"precision\(quantity\): 1 rows"):
        quality.enforce("sales", cleaned)
    assert "overflowed_columns" not in cleaning.clean("sales", landed).columns


def test_a_required_number_too_large_is_reported(text_rows):
    rate = dict(rate_date="2024-12-01", currency_code="USD", currency_name="US dollar", rate_to_rub="1e9")
    landed = text_rows("currency_rates", [rate])
    assert cleaning.clean("currency_rates", landed).count() == 0
    with pytest.raises(QualityError, match="precision"):
        quality.enforce("currency_rates", cleaning.clean("currency_rates", landed, overflow=True))


def test_rules_are_counted_while_rows_are_written(spark, text_rows, tmp_path):
    landed = text_rows("sales", [SALE, SALE | {"sale_id": "2", "revenue": "1e12", "profit": None}])
    rows, seen = quality.watched("sales", cleaning.clean("sales", landed, overflow=True))
    rows.write.parquet(str(tmp_path / "stage"))
    assert {k: n for k, n in seen.get.items() if n} == {"not_null profit": 1, "precision revenue": 1}
    staged = spark.read.parquet(str(tmp_path / "stage"))
    with pytest.raises(QualityError, match=r"not_null\(profit\): 1 rows; precision\(revenue\): 1 rows"):
        quality.enforce("sales", staged, seen)
    with pytest.raises(QualityError, match=r"unique\(sale_id\): 4 rows"):
        quality.enforce("sales", staged.unionAll(staged), {"not_null profit": 0})
    quality.enforce("sales", staged, {})
