"""Ratios near a tie, sums around a long, and what the marts shuffle."""

from decimal import Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from shopledger.functions.numbers import pct, ratio, unscaled
from shopledger.operators.aligning import Side, align
from shopledger.operators.ranking import with_ranks
from shopledger.plans.kpi_mart import store_monthly_heatmap
from shopledger.plans.sales import with_store
from shopledger.sources.star_schema import StarSchemaTables


def half_up(top, bottom, digits, times=1):
    steps = Fraction(top) / Fraction(bottom) * times * 10**digits
    whole = int(abs(steps) + Fraction(1, 2))
    return Decimal(whole if steps >= 0 else -whole).scaleb(-digits)


def test_ratios_round_half_up_at_and_beside_a_tie(spark):
    pairs = [("1.00", "8"), ("-1.00", "8"), ("0.005", "1"), ("2.675", "1"), ("100.00", "3"),
             ("0.01", "200"), ("-7", "3"), ("9999999.99", "0.01"), ("12.345", "1"),
             ("1234567.89", "4567.8"), ("4999.9999", "10000"), ("5000.0001", "10000")]
    frame = spark.createDataFrame(
        [(Decimal(a), Decimal(b)) for a, b in pairs], "a decimal(18,4), b decimal(18,4)")
    for digits in (2, 4, 8):
        got = frame.select("a", "b", ratio("a", "b", digits).alias("r"), pct("a", "b", digits).alias("p"))
        for a, b, r, p in got.collect():
            assert r == half_up(a, b, digits) and p == half_up(a, b, digits, 100), (a, b, digits)
    gone = frame.select(ratio("a", F.lit(0)).alias("r"), ratio(F.lit(None).cast("int"), "b").alias("n"))
    assert {tuple(row) for row in gone.collect()} == {(None, None)}


def test_long_and_longer_sums_of_parts(spark):
    parts = [(5, 7), (-5, 7), ((1 << 37) - 1, (1 << 61) - 1), (1 << 37, 0), (-(1 << 38), 3), (0, 1 << 61)]
    frame = spark.createDataFrame(parts, "high long, low long")
    got = frame.select("high", "low", unscaled(F.col("high"), F.col("low"), 2).alias("x")).collect()
    assert all(r.x == Decimal(r.high * (1 << 24) + r.low).scaleb(-2) for r in got)


def test_rows_with_null_keys_meet_when_asked(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 4)], "k string, n long")
    sides = {"left": Side(frame, ["k"], {"x": "n"}), "right": Side(frame, ["k"], {"y": "n"})}
    assert sorted(map(tuple, align(["k"], sides).select("x", "y").collect()), key=str) == [
        (3, None), (4, 4), (None, 3)]
    assert {tuple(r) for r in align(["k"], sides, nulls_meet=True).select("x", "y").collect()} == {
        (3, 3), (4, 4)}


def test_nulls_are_ranked_as_in_a_plain_window(spark):
    frame = spark.createDataFrame(
        [(None, 1, 5.0), (None, 2, None), ("", 3, 1.0), ("a", 4, None), ("a", 5, None), ("a", 6, -2.0)],
        "part string, id int, amount double")
    got = with_ranks(frame, "part", {"up": F.col("amount"), "down": -F.col("amount")})
    assert {(r.id, r.up, r.down) for r in got.collect()} == {
        (1, 2, 2), (2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 1, 1), (6, 3, 3)}


def test_heatmap_shuffles_facts_by_store_only(make):
    tables = make(sales=[{}], plan_sales=[{}], inventory=[{}])
    plan = store_monthly_heatmap(tables)._jdf.queryExecution().optimizedPlan().toString()
    # categories are grouped for the stock alone, and no row is stacked or grouped whole for its ranks
    assert plan.count("category#") and not any(
        "Aggregate [" in line and "category#" in line and "stock_month#" not in line
        for line in plan.split("\n"))
    assert "revenue_rank#" in plan and not any(
        "Aggregate [" in line and "revenue_rank#" in line for line in plan.split("\n"))


def test_size_of_stores_is_known_before_they_are_joined(spark, tmp_path):
    places = {
        "supplier": "SELECT id AS s_suppkey, concat('s', id) AS s_name, CAST(id % 4 AS INT) AS s_nationkey"
                    " FROM range(8)",
        # nation 1 twice, nation 2 in no region, nation 3 missing
        "nation": "SELECT * FROM VALUES (0, 'A', 0), (1, 'B', 0), (1, 'C', 1), (2, 'D', 9), (NULL, 'E', 0)"
                  " AS t(n_nationkey, n_name, n_regionkey)",
        "region": "SELECT * FROM VALUES (0, 'X'), (1, 'Y') AS t(r_regionkey, r_name)",
    }
    for name, sql in places.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    tables = StarSchemaTables(spark, str(tmp_path))
    got = {(r.store_name, r.city, r.region) for r in tables["stores"].collect()}
    assert got == {("s0", "A", "X"), ("s4", "A", "X"), ("s1", "B", "X"), ("s1", "C", "Y"),
                   ("s5", "B", "X"), ("s5", "C", "Y")}
    facts = spark.range(10).select(F.concat(F.lit("S"), F.lpad("id", 6, "0")).alias("store_id"))
    planned = with_store(facts, tables)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [store_id" in planned and "SortMergeJoin" not in planned
