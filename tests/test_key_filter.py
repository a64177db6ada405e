from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.operators import key_filter
from shopledger.operators.key_filter import maybe_among
from shopledger.sources.warehouse import Warehouse


def test_no_key_is_lost_and_few_others_pass(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("S"), F.col("id")).alias("k"), F.lit("x").alias("bits"))
    keys = rows.filter("substring(k, 2) % 97 = 0").select("k")
    kept = maybe_among(rows, keys, ["k"], keys.count())
    assert kept.columns == ["k", "bits"]
    assert kept.join(keys, "k", "left_semi").count() == keys.count()
    assert kept.count() < keys.count() + 200_000 * 0.03


def test_composite_null_and_no_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "n int, t string")
    keys = rows.filter("n <> 1")
    assert {r.n for r in maybe_among(rows, keys, ["n", "t"], 2).collect()} >= {2, 3}
    assert maybe_among(rows, keys.limit(0), ["n", "t"], 0).count() == 0


def test_more_keys_than_the_bound_let_all_rows_pass(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "MOST_KEYS", 1)
    rows = spark.range(5).withColumnRenamed("id", "k")
    assert maybe_among(rows, rows.limit(2), ["k"], 2).count() == 5


@pytest.fixture
def warehouse(spark, make, tmp_path):
    """Months whose sale ids don't overlap, but for March."""
    house = Warehouse(spark, str(tmp_path))
    rows = [dict(sale_id=f"T{m:02}{i}", sale_date=date(2024, m, 1)) for m in (1, 2, 3) for i in range(3)]
    rows.append(dict(sale_id="T00", sale_date=date(2024, 3, 9)))
    house.publish(house.merge("sales", make(sales=rows)["sales"]))
    return house


def test_a_sales_merge_reads_months_that_can_hold_its_keys(warehouse, make, rows):
    read, plain = [], warehouse._read
    warehouse._read = lambda entity, current: read.append(sorted(current)) or plain(entity, current)
    new = make(sales=[dict(sale_id="T021", sale_date=date(2024, 2, 20), revenue="7"),
                      dict(sale_id="T029", sale_date=date(2024, 2, 21))])["sales"]
    changes = warehouse.merge("sales", new)
    assert read[0] == ["2024-02", "2024-03"]  # keys of January lie apart
    assert [c[1] for c in changes] == ["2024-02"]
    warehouse.publish(changes)
    assert warehouse._stored_ranges("sales")["2024-02"] == ("T020", "T029")
    got = {r["sale_id"]: r["revenue"] for r in rows(warehouse.core("sales"))}
    assert len(got) == 11 and got["T021"] == 7


def test_a_sale_is_found_in_another_month(warehouse, make, rows):
    warehouse.publish(warehouse.merge("sales", make(sales=[dict(sale_id="T00", sale_date=date(2024, 1, 5))])["sales"]))
    got = [(r["sale_id"], r["sale_month"]) for r in rows(warehouse.core("sales"), "sale_id")]
    assert got[0] == ("T00", "2024-01") and len(got) == 10


def test_stored_keys_are_not_shuffled_before_they_are_filtered(warehouse, make, spark):
    keys = make(sales=[dict(sale_id="T021")])["sales"].select("sale_id")
    entity_rows = warehouse.core("sales").select("sale_id", "sale_month")
    plan = maybe_among(entity_rows, keys, ["sale_id"], 1)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("FileScan parquet")[0]
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2 and "hashpartitioning(sale_id" not in above
