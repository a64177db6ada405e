from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.functions import text
from shopledger.functions.parsing import day, moment
from shopledger.operators import cleaning, integrity, merge, quality
from shopledger.operators.cleaning import dropped
from shopledger.operators.selectors import apply_selectors, check_date, check_month

SALE = dict(
    sale_id="1", invoice_no="I1", invoice_type="sale", sale_datetime="2024-12-01 10:00:00",
    sale_date="2024-12-01", sale_month="2024-12", store_id="S1", product_id="P1", category="Tea",
    quantity="2", unit_price="10", discount_rate="0.1", revenue="18", unit_cost="5",
    total_cost="10", profit="8",
)


@pytest.fixture
def clean_sales(text_rows, rows):
    def run(*changes):
        landed = text_rows("sales", [SALE | c for c in changes])
        return rows(cleaning.clean_sales(landed), "sale_id")

    return run


def test_invalid_first_copy_hides_a_later_valid_one(clean_sales):
    assert clean_sales({"quantity": "-1"}, {"quantity": "5"}) == []


def test_first_copy_wins(clean_sales):
    assert clean_sales({"quantity": "3"}, {"quantity": "5"})[0]["quantity"] == 3


def test_fraction_passes_and_is_cut_to_zero(clean_sales, make, rows):
    assert clean_sales({"quantity": "0.5"})[0]["quantity"] == 0


@pytest.mark.parametrize("change", [
    {"sale_date": "2024-13-01"}, {"sale_datetime": "soon"}, {"store_id": "N/A"},
    {"category": ""}, {"quantity": "many"}, {"quantity": "0"}, {"unit_price": "-1"},
    {"revenue": "-0.01"}, {"unit_price": "nan"}, {"sale_id": None},
])
def test_unusable_rows_are_dropped(clean_sales, change):
    assert clean_sales(change) == []


def test_values_are_rounded_half_up(clean_sales):
    [got] = clean_sales({"revenue": "2.675", "unit_price": "1e3", "discount_rate": "x",
                         "quantity": "3.7", "profit": " 1.005 "})
    assert got["revenue"] == 2.68 and got["unit_price"] == 1000 and got["profit"] == 1.01
    assert got["discount_rate"] == 0 and got["quantity"] == 3
    assert got["description"] is None


def test_slightly_negative_revenue_is_judged_after_rounding(clean_sales):
    assert clean_sales({"revenue": "-0.004"})[0]["revenue"] == 0


def test_missing_money_passes_cleaning_and_fails_the_check(clean_sales, text_rows):
    assert clean_sales({"total_cost": "abc"})[0]["total_cost"] is None
    landed = text_rows("sales", [SALE | {"total_cost": "abc"}, SALE | {"sale_id": "2"}])
    cleaned = cleaning.clean_sales(landed)
    with pytest.raises(quality.QualityError, match="total_cost"):
        quality.enforce("sales", cleaned)
    good, bad = quality.split_rejects("sales", cleaned)
    assert [r.sale_id for r in good.collect()] == ["2"]
    assert [r.missing_columns for r in bad.collect()] == ["total_cost"]


def test_too_large_a_number_is_reported(text_rows):
    cleaned = cleaning.clean_sales(text_rows("sales", [SALE | {"profit": "1e13"}]))
    [got] = quality.violations("sales", cleaned).collect()
    assert (got.rule, got["columns"], got.bad_rows) == ("not_null", "profit", 1)


def test_repeated_key_is_reported(text_rows):
    plan = dict(plan_month="2024-12", store_id="S1", category="Tea")
    frame = cleaning.clean_plan(text_rows("plan_sales", [plan]))
    [got] = quality.violations("plan_sales", frame.union(frame)).collect()
    assert (got.rule, got.bad_rows) == ("unique", 2)
    quality.enforce("plan_sales", frame)


def test_fill_values(text_rows, rows):
    store = dict(store_id="S1", store_name="a", city="b", region="c", format="d",
                 opening_date="2020-02-01", store_area_sqm="12.9", employees_count="few")
    [got] = rows(cleaning.clean_stores(text_rows("stores", [store])))
    assert (got["store_area_sqm"], got["employees_count"]) == (12, 0)
    assert got["opening_date"] == date(2020, 2, 1)
    product = dict(product_id="P1", product_name="a", category="b", unit_cost="NULL", is_active="")
    [got] = rows(cleaning.clean_products(text_rows("products", [product])))
    assert (got["unit_cost"], got["unit_price"], got["is_active"]) == (0, 0, 1)
    stock = dict(inventory_date="2024-12-31", store_id="S1", product_id="P1", stock_qty="-2.5",
                 days_of_cover="3.455", stock_status="OK")
    [got] = rows(cleaning.clean_inventory(text_rows("inventory", [stock])))
    assert (got["stock_qty"], got["stock_value"], got["days_of_cover"]) == (-2, 0, 3.46)


def test_last_load_of_a_rate_wins(spark, text_rows, rows):
    rate = dict(rate_date="2024-12-01", currency_code="USD", currency_name="US dollar")
    landed = text_rows("currency_rates", [
        rate | {"rate_to_rub": "90.12345", "nominal": ""}, rate | {"rate_to_rub": "80"},
    ]).withColumn("load_dttm", -F.col("landing_position"))
    [got] = rows(cleaning.clean_rates(landed))
    assert (got["rate_to_rub"], got["nominal"]) == (90.1235, 1)


def test_orphans(make, rows):
    tables = make(
        sales=[{}, {"store_id": "S9"}, {"product_id": "P9"}],
        inventory=[{}, {"product_id": "P9"}],
        plan_sales=[{"category": "Unheard of"}, {"store_id": "S9"}],
    )
    assert integrity.related("sales", tables["sales"], tables.get).count() == 1
    assert integrity.related("inventory", tables["inventory"], tables.get).count() == 1
    kept = rows(integrity.related("plan_sales", tables["plan_sales"], tables.get))
    assert [r["category"] for r in kept] == ["Unheard of"]


def test_merge_replaces_adds_and_keeps(make, rows):
    old = make(stores=[{"store_id": "S1"}, {"store_id": "S2"}])["stores"]
    new = make(stores=[{"store_id": "S2", "city": "Moscow"}, {"store_id": "S3"}])["stores"]
    once = merge.upsert_stores(old, new, stamp=False)
    assert [(r["store_id"], r["city"]) for r in rows(once, "store_id")] == [
        ("S1", "Tver"), ("S2", "Moscow"), ("S3", "Tver")]
    twice = merge.upsert_stores(once, new, stamp=False)
    assert rows(twice, "store_id") == rows(once, "store_id")


@pytest.mark.parametrize("number, shown", [
    (59.0, "59%"), (0.59, "59%"), (100.0, "100%"), (0.0, "0%"), (None, "0%"), (59.25, "59.2%"),
    (59.45, "59.5%"), (-0.5, "-50%"), (1234.5, "1234.5%"), (1.0, "100%"),
])
def test_percent_text(value, number, shown):
    assert value(text.pct_text("x"), "x double", number) == shown


@pytest.mark.parametrize("number, shown", [
    (1234567.4, "1 234 567"), (2.5, "2"), (3.5, "4"), (None, "0"), (-1234.0, "-1 234"),
])
def test_money_text(value, number, shown):
    assert value(text.money_text("x"), "x double", number) == shown


@pytest.mark.parametrize("month, shown", [
    ("2024-12", "December 2024"), ("2024-13", "13 2024"), ("", "not stated"),
    (None, "not stated"), ("2024", "2024"),
])
def test_month_label(value, month, shown):
    assert value(text.month_label("x"), "x string", month) == shown


def test_names(value):
    schema = "x array<struct<id:string>>"
    assert value(text.names("x", "id"), schema, [("a",), (None,), ("b",)]) == "a, b"
    assert value(text.names("x", "id"), schema, []) == "no data"
    assert value(text.first_name("x", "id"), schema, [("a",), ("b",)]) == "a"
    assert value(text.first_name("x", "id"), schema, []) == "no data"


def test_argument_checks():
    assert check_month("2024-12") == "2024-12"
    assert check_date("2024-12-31") == date(2024, 12, 31)
    for wrong in ("2024-1", "2024/12", "december", None, "2024-12-01"):
        with pytest.raises(ValueError):
            check_month(wrong)
    for wrong in ("2024-13-01", "31.12.2024", None):
        with pytest.raises(ValueError):
            check_date(wrong)


def test_selectors(make):
    sales = make(sales=[{"category": "A"}, {"category": "B"}, {"category": "C"}])["sales"]
    assert apply_selectors(sales, {"category": ["A", "B"], "store_id": []}).count() == 2
    assert apply_selectors(sales, {"category": "C"}).count() == 1


@pytest.mark.parametrize("text, expected", [
    ("2024-12-31", "2024-12-31"), ("2024/12/31", "2024-12-31"), ("31.12.2024", "2024-12-31"),
    ("12/31/2024", "2024-12-31"), ("20241231", "2024-12-31"), (" 2024-1-5 ", "2024-01-05"),
    ("2024-12-31 10:00:00", "2024-12-31"), ("31.12.2024T08:15", "2024-12-31"),
    ("2024-12-31 abc", None), ("2024-13-01", None), ("31/12/2024", None), ("202412311", None),
    ("", None), (None, None), ("2024-02-30", None),
])
def test_ways_of_writing_a_day(value, text, expected):
    got = value(day(F.col("x")).cast("string"), "x string", text)
    assert got == expected


@pytest.mark.parametrize("text, expected", [
    ("2024-12-31 10:05:07.25", "2024-12-31 10:05:07.25"), ("2024/12/31 9:05", "2024-12-31 09:05:00"),
    ("20241231", "2024-12-31 00:00:00"), ("2024-12-31 25:00", None), ("2024-12-31 10:00 x", None),
])
def test_ways_of_writing_a_moment(value, text, expected):
    assert value(moment(F.col("x")).cast("string"), "x string", text) == expected


def test_reasons_for_rows_left_out(text_rows, rows):
    good = {"sale_id": "1", "invoice_no": "I", "sale_date": "2024-12-01", "sale_month": "2024-12", "store_id": "S", "product_id": "P",
            "category": "Tea", "quantity": "1", "unit_price": "1", "revenue": "1", "sale_datetime": "2024-12-01"}
    landed = text_rows("sales", [
        good, good | {"sale_id": "2", "quantity": "-1"}, good | {"sale_id": "3", "sale_date": "soon"},
        good | {"sale_id": "4", "sale_date": "later", "store_id": ""}, good, good | {"sale_id": ""},
    ])
    got = {r["reason"]: r["rows"] for r in rows(dropped("sales", landed))}
    assert got == {"out of range": 1, "no usable sale_date": 2, "no usable store_id": 1}
