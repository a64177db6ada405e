import os
import time
from datetime import date

import pytest
from pyspark.errors import AnalysisException

from shopledger.plans import ingest
from shopledger.plans.registry import MARTS, register_all
from shopledger.sources import rates
from shopledger.sources.landing import read_landing
from shopledger.operators.quality import QualityError
from shopledger.sources.warehouse import PublicationConflict, Warehouse
from shopledger.streaming.incremental import ingest_available

SALES_HEADER = (
    "sale_id,invoice_no,invoice_type,sale_datetime,sale_date,sale_month,store_id,product_id,"
    "stock_code,description,category,quantity,unit_price,discount_rate,revenue,unit_cost,"
    "total_cost,profit,customer_id,country,sales_channel"
)


def sale(number, day="2024-12-01", store="S001", revenue="18", quantity="2"):
    return (
        f'{number},I{number},sale,{day} 10:00:00,{day},{day[:7]},{store},P0001,1,"Tea, ""best""",'
        f"Tea,{quantity},10,0.1,{revenue},5,10,8,C1,RU,online"
    )


def write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


@pytest.fixture
def landing(tmp_path):
    folder = str(tmp_path / "landing")
    write(folder, "stores.csv",
          "store_id,store_name,city,region,format,opening_date,store_area_sqm,employees_count",
          "S001,One,Tver,Central,Convenience,2020-01-01,100,10",
          "S002,Two,Kazan,Volga,Hypermarket,2021-01-01,200,20",
          "S001,Copy,Tver,Central,Convenience,2020-01-01,100,10")
    write(folder, "products.csv",
          "product_id,stock_code,product_name,category,subcategory,brand,supplier,unit_cost,"
          "unit_price,uom,is_active",
          "P0001,1,Tea 1,Tea,Green,Daily,V1,5,10,pcs,")
    write(folder, "sales.csv", SALES_HEADER, sale(1), sale(2, "2024-11-30"), sale(2, "2024-10-01"),
          sale(3, store="S999"))
    write(folder, "inventory.csv",
          "inventory_date,store_id,product_id,stock_qty,stock_value,reorder_point,days_of_cover,"
          "stock_status",
          "2024-12-31,S001,P0001,5,50,15,3,LOW", "2024-12-31,S001,P0009,5,50,15,3,LOW")
    write(folder, "plan_sales.csv",
          "plan_month,store_id,category,plan_revenue,plan_profit,plan_qty",
          "2024-12,S001,Tea,100,50,10", "2024-12,S777,Tea,100,50,10")
    return folder


@pytest.fixture
def rate_files(tmp_path):
    daily, history = tmp_path / "daily", tmp_path / "history"
    daily.mkdir()
    history.mkdir()
    (daily / "2024-12-02.xml").write_text(
        '<?xml version="1.0" encoding="windows-1251"?>\n'
        '<ValCurs Date="02.12.2024" name="Market">'
        '<Valute ID="R01235"><CharCode>USD</CharCode><Nominal>1</Nominal>'
        "<Name>Доллар США</Name><Value>106,1878</Value></Valute>"
        '<Valute ID="R01375"><CharCode>cny</CharCode><Nominal>10</Nominal>'
        "<Name>Юань</Name><Value>95,5000</Value></Valute>"
        '<Valute ID="R01010"><CharCode>AUD</CharCode><Nominal>1</Nominal>'
        "<Name>Other</Name><Value>69,0</Value></Valute></ValCurs>", encoding="cp1251")
    (history / "R01235.xml").write_text(
        '<?xml version="1.0" encoding="windows-1251"?>\n<ValCurs ID="R01235" name="History">'
        '<Record Date="01.12.2024" Id="R01235"><Nominal>1</Nominal><Value>107,7</Value>'
        "<VunitRate>107,7409</VunitRate></Record>"
        '<Record Date="02.12.2024" Id="R01235"><Nominal>1</Nominal><Value>106,1878</Value>'
        "</Record></ValCurs>", encoding="cp1251")
    (history / "R01375.xml").write_text(
        '<?xml version="1.0" encoding="windows-1251"?>\n<ValCurs ID="R01375" name="History">'
        '<Record Date="02.12.2024"><Nominal>10</Nominal><Value>95,5000</Value></Record></ValCurs>',
        encoding="cp1251")
    (history / "R09999.xml").write_text(
        '<?xml version="1.0" encoding="windows-1251"?>\n<ValCurs ID="R09999" name="History">'
        '<Record Date="02.12.2024" Id="R09999"><Nominal>1</Nominal><Value>1</Value></Record>'
        "</ValCurs>", encoding="cp1251")
    return ingest.RateFiles(str(daily), str(history))


def test_landing_rows_keep_file_order_and_source(spark, landing):
    got = read_landing(spark, landing, "sales").orderBy("landing_position").collect()
    assert [r.sale_id for r in got] == ["1", "2", "2", "3"]
    assert got[0].description == 'Tea, "best"' and got[0].source_file == "sales.csv"
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_landing(spark, landing + "/nowhere", "sales")


def test_daily_rates(spark, rate_files, rows):
    got = rows(rates.read_rates_daily_xml(spark, rate_files.daily), "currency_code")
    assert [(r["currency_code"], r["rate_date"], r["rate_to_rub"], r["nominal"]) for r in got] == [
        ("CNY", "2024-12-02", "9.5500", "10"), ("USD", "2024-12-02", "106.1878", "1")]
    assert got[1]["currency_name"] == "Доллар США"
    with pytest.raises(ValueError):
        rates.require_rates(rates.read_rates_daily_xml(spark, rate_files.daily, ["XXX"]))
    assert rates.currency_codes(" usd, eur,,") == ("USD", "EUR")


def test_rate_history(spark, rate_files, rows):
    currencies = rates.read_currency_dim(spark, rate_files.daily)
    history = rates.read_rates_history_xml(spark, rate_files.history, currencies)
    got = rows(history, "currency_code", "rate_date")
    assert [(r["currency_code"], r["rate_date"], r["rate_to_rub"]) for r in got] == [
        ("CNY", "2024-12-02", "9.5500"), ("USD", "2024-12-01", "107.7409"),
        ("USD", "2024-12-02", "106.1878")]
    later = rates.read_rates_history_xml(
        spark, rate_files.history, currencies, start=date(2024, 12, 2), end=date(2024, 12, 2))
    assert later.count() == 2


def test_full_run_twice(spark, landing, rate_files, tmp_path, rows):
    root = str(tmp_path / "warehouse")
    first = ingest.run(spark, landing, root, rate_files)
    def state(w):
        return {
            n: [{k: v for k, v in r.items() if k != "updated_at"}
                for r in rows(w.core(n), *w.core(n).columns[:3])]
            for n in ingest.MERGE_ORDER
        }
    before = state(first)
    assert [(r["sale_id"], r["sale_month"]) for r in before["sales"]] == [
        ("1", "2024-12"), ("2", "2024-11")]
    assert [r["store_name"] for r in before["stores"]] == ["One", "Two"]
    assert len(before["inventory"]) == 1 and len(before["plan_sales"]) == 1
    assert len(before["currency_rates"]) == 3
    again = ingest.run(spark, landing, root, rate_files)
    assert state(again) == before
    assert again.raw("sales").count() == 8  # raw keeps every load
    stored = again.raw("sales").first()
    assert stored.source_file == "sales.csv" and stored.load_dttm is not None

    names = register_all(again.tables(), prefix="t_")
    assert len(names) == 6 + len(MARTS)
    [got] = rows(spark.sql("SELECT * FROM t_monthly_kpi WHERE sale_month = '2024-12'"))
    assert got["revenue"] == 18
    assert rows(again.core("sales", months=["2024-11"]))[0]["sale_id"] == "2"

    ingest.marts_to_tables(again, str(tmp_path / "marts"))
    assert spark.read.parquet(str(tmp_path / "marts" / "fx_risk_metrics")).count() == 2


def test_sale_that_moves_to_another_month(spark, landing, tmp_path, rows):
    root = str(tmp_path / "warehouse")
    ingest.run(spark, landing, root)
    write(landing, "sales.csv", SALES_HEADER, sale(2, "2024-12-24"))
    warehouse = ingest.run(spark, landing, root)
    got = rows(warehouse.core("sales"), "sale_id")
    assert [(r["sale_id"], r["sale_month"]) for r in got] == [("1", "2024-12"), ("2", "2024-12")]
    assert rows(warehouse.core("sales", months=["2024-11"])) == []


def test_untouched_months_are_not_rewritten(spark, landing, tmp_path):
    root = str(tmp_path / "warehouse")
    warehouse = ingest.run(spark, landing, root)
    before = warehouse._current("sales")
    write(landing, "sales.csv", SALES_HEADER, sale(9, "2024-12-24"))
    ingest.run(spark, landing, root)
    after = warehouse._current("sales")
    assert after["2024-11"] == before["2024-11"] and after["2024-12"] > before["2024-12"]


def test_unpublished_changes_are_invisible(spark, landing, tmp_path, rows):
    root = str(tmp_path / "warehouse")
    warehouse = ingest.run(spark, landing, root)
    write(landing, "sales.csv", SALES_HEADER, sale(9))
    ingest.stage_csv(spark, landing, warehouse)
    changes = warehouse.merge("sales", warehouse.staged("sales"))
    assert warehouse.core("sales").count() == 2
    warehouse.publish(changes)
    assert warehouse.core("sales").count() == 3


def test_incremental_ingest(spark, landing, tmp_path, rows):
    root, drop = str(tmp_path / "warehouse"), str(tmp_path / "drop")
    ingest.run(spark, landing, root)
    progress = str(tmp_path / "progress")

    def run():
        query = ingest_available(spark, drop, root, "sales", progress)
        query.awaitTermination()
        return {r["sale_id"]: r["revenue"] for r in rows(Warehouse(spark, root).core("sales"))}

    write(drop, "a.csv", SALES_HEADER, sale(1, revenue="20"), sale(7, revenue="30"))
    assert run() == {"1": 20, "2": 18, "7": 30}
    write(drop, "c.csv", SALES_HEADER, sale(7, revenue="31"), sale(8, revenue="1"))
    time.sleep(1.1)
    # the newer file names sale 7 first with an unusable row: the older file's version stays
    write(drop, "b.csv", SALES_HEADER, sale(7, quantity="-1"), sale(7), sale(8, revenue="2"))
    assert run() == {"1": 20, "2": 18, "7": 31, "8": 2}
    assert run() == {"1": 20, "2": 18, "7": 31, "8": 2}


def test_a_sale_before_its_store_is_merged_later(spark, landing, tmp_path, rows):
    root, drop, progress = (str(tmp_path / n) for n in ("warehouse", "drop", "progress"))
    ingest.run(spark, landing, root)

    def run():
        ingest_available(spark, drop, root, "sales", progress).awaitTermination()
        return {r["sale_id"]: r["revenue"] for r in rows(Warehouse(spark, root).core("sales"))}

    write(drop, "a.csv", SALES_HEADER, sale(7, store="S003", revenue="30"), sale(8, store="S004"))
    assert run() == {"1": 18, "2": 18}
    stores = str(tmp_path / "stores")
    write(stores, "late.csv",
          "store_id,store_name,city,region,format,opening_date,store_area_sqm,employees_count",
          "S003,Three,Tver,Central,Convenience,2020-01-01,100,10")
    ingest_available(spark, stores, root, "stores", str(tmp_path / "p2")).awaitTermination()
    write(drop, "b.csv", SALES_HEADER, sale(9))
    assert run() == {"1": 18, "2": 18, "7": 30, "9": 18}
    assert [r["sale_id"] for r in rows(Warehouse(spark, root).pending("sales"))] == ["8"]
    # a newer version of a waiting sale replaces it
    write(drop, "c.csv", SALES_HEADER, sale(8, revenue="5"))
    assert run() == {"1": 18, "2": 18, "7": 30, "8": 5, "9": 18}
    assert rows(Warehouse(spark, root).pending("sales")) == []


def test_two_writers_of_one_month(spark, landing, tmp_path, rows):
    root = str(tmp_path / "warehouse")
    ingest.run(spark, landing, root)
    one, two = Warehouse(spark, root), Warehouse(spark, root)
    assert one.staging_path("sales") != two.staging_path("sales")
    changes = []
    for warehouse, number in ((one, 11), (two, 12)):
        write(landing, "sales.csv", SALES_HEADER, sale(number))
        ingest.stage_csv(spark, landing, warehouse)
        changes.append(warehouse.merge("sales", warehouse.staged("sales")))
    one.publish(changes[0])
    with pytest.raises(PublicationConflict, match="2024-12"):
        two.publish(changes[1])
    two.publish(two.merge("sales", two.staged("sales")))
    assert [r["sale_id"] for r in rows(two.core("sales"), "sale_id")] == ["1", "11", "12", "2"]


def test_rejects_are_set_aside_on_request(spark, landing, tmp_path, rows):
    write(landing, "sales.csv", SALES_HEADER, sale(1), sale(2).replace(",5,10,8,", ",5,abc,8,"))
    with pytest.raises(QualityError):
        ingest.run(spark, landing, str(tmp_path / "strict"))
    warehouse = ingest.run(spark, landing, str(tmp_path / "lenient"), keep_rejects=True)
    assert [r["sale_id"] for r in rows(warehouse.core("sales"))] == ["1"]
    [reject] = rows(spark.read.parquet(warehouse.rejects_path("sales")))
    assert (reject["sale_id"], reject["missing_columns"]) == ("2", "total_cost")


def test_rate_settings(spark, landing, rate_files, tmp_path, rows):
    chosen = ingest.RateFiles(
        rate_files.daily, rate_files.history, codes=" usd,", start=date(2024, 12, 2), end=date(2024, 12, 2))
    got = rows(ingest.run(spark, landing, str(tmp_path / "w"), chosen).core("currency_rates"))
    assert [(r["currency_code"], str(r["rate_date"])) for r in got] == [("USD", "2024-12-02")]


def test_a_plan_merge_reads_only_its_months(spark, landing, tmp_path):
    root = str(tmp_path / "warehouse")
    write(landing, "plan_sales.csv", "plan_month,store_id,category,plan_revenue,plan_profit,plan_qty",
          "2024-12,S001,Tea,100,50,10", "2024-11,S001,Tea,100,50,10")
    warehouse = ingest.run(spark, landing, root)
    read = []
    plain = warehouse._read
    warehouse._read = lambda entity, current: read.append(sorted(current)) or plain(entity, current)
    write(landing, "plan_sales.csv", "plan_month,store_id,category,plan_revenue,plan_profit,plan_qty",
          "2024-12,S001,Tea,120,50,10")
    ingest.stage_csv(spark, landing, warehouse)
    warehouse.merge("plan_sales", warehouse.staged("plan_sales"))
    assert read == [["2024-12"]]


def test_files_are_loaded_once(spark, landing, rate_files, tmp_path, rows):
    root = str(tmp_path / "warehouse")
    first = ingest.run(spark, landing, root, rate_files, only_new=True)

    def state(w):
        return {n: sorted(map(str, w.core(n).drop("updated_at").collect())) for n in ingest.MERGE_ORDER}

    def counts(w):
        return [w.raw(n).count() for n in ingest.MERGE_ORDER]

    before, loaded = state(first), counts(first)
    assert loaded == [3, 1, 4, 2, 2, 3]
    again = ingest.run(spark, landing, root, rate_files, only_new=True)
    assert counts(again) == loaded and state(again) == before
    assert not os.path.exists(again.staging_path("sales"))

    # a new history file: only its load is read for staging, and it replaces what it names
    (tmp_path / "history" / "R01235b.xml").write_text(
        '<ValCurs ID="R01235"><Record Date="02.12.2024" Id="R01235"><Nominal>1</Nominal>'
        "<Value>110,5</Value></Record></ValCurs>", encoding="cp1251")
    third = ingest.run(spark, landing, root, rate_files, only_new=True)
    assert third.raw("currency_rates").count() == 4 and third.staged("currency_rates").count() == 1
    rates_now = {(r["currency_code"], str(r["rate_date"])): r["rate_to_rub"] for r in rows(third.core("currency_rates"))}
    assert rates_now[("USD", "2024-12-02")] == 110.5 and rates_now[("USD", "2024-12-01")] == 107.7409
    assert {n: s for n, s in state(third).items() if n != "currency_rates"} == {
        n: s for n, s in before.items() if n != "currency_rates"}


def test_a_load_that_died_is_invisible(spark, landing, tmp_path):
    from shopledger.sources.landing import append_raw

    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    append_raw(read_landing(spark, landing, "sales"), warehouse.raw_path("sales"), "2024-01-01T00-00-00-dead")
    assert warehouse.raw("sales").count() == 0
    ingest.load_raw(spark, landing, warehouse, only_new=True)
    assert warehouse.raw("sales").count() == 4
    assert warehouse.raw("sales", since="2999-01-01").count() == 0
    # the same file with other contents is new
    write(landing, "sales.csv", SALES_HEADER, sale(1), sale(9))
    loads = ingest.load_raw(spark, landing, warehouse, only_new=True)
    assert [n for n, load in loads.items() if load] == ["sales"] and warehouse.raw("sales").count() == 6
    assert warehouse.raw("sales", since=loads["sales"]).count() == 2


def test_a_run_names_numbers_that_are_too_large(spark, landing, tmp_path, rows):
    write(landing, "sales.csv", SALES_HEADER, sale(1), sale(2, revenue="1000000000000"))
    with pytest.raises(QualityError, match=r"sales: precision\(revenue\): 1 rows$"):
        ingest.run(spark, landing, str(tmp_path / "strict"))
    warehouse = ingest.run(spark, landing, str(tmp_path / "lenient"), keep_rejects=True)
    [reject] = rows(spark.read.parquet(warehouse.rejects_path("sales")))
    assert reject["overflowed_columns"] == ["revenue"] and reject["sale_id"] == "2"


def test_a_run_that_reads_dates_by_column(spark, landing, tmp_path, rows):
    write(landing, "plan_sales.csv", "plan_month,store_id,category,plan_revenue,plan_profit,plan_qty",
          "2024-12,S001,Tea,100,50,10")
    write(landing, "sales.csv", SALES_HEADER, sale(1, "2024-12-01").replace(",2024-12-01,", ",12/01/2024,"),
          sale(2, "2024-12-01").replace(",2024-12-01,", ",12/31/2024,"))
    warehouse = ingest.run(spark, landing, str(tmp_path / "w"), dates="column")
    assert [str(r["sale_date"]) for r in rows(warehouse.core("sales"), "sale_id")] == ["2024-12-01", "2024-12-31"]


def test_a_replayed_batch_changes_nothing(spark, landing, tmp_path, rows, monkeypatch):
    from shopledger.schemas import ENTITIES
    from shopledger.sources.landing import CSV_OPTIONS
    from shopledger.sources.ledger import Ledger
    from shopledger.streaming import incremental

    root, drop = str(tmp_path / "warehouse"), str(tmp_path / "drop")
    ingest.run(spark, landing, root)
    write(drop, "a.csv", SALES_HEADER, sale(7, revenue="30"), sale(8).replace(",5,10,8,", ",5,abc,8,"))
    batch = incremental.tagged(spark.read.schema(ENTITIES["sales"].landed).options(**CSV_OPTIONS).csv(drop))

    def run():
        incremental._merge_batch(Warehouse(spark, root), "sales", batch, 0, "progress", True, "each")
        house = Warehouse(spark, root)
        rejects = spark.read.parquet(f"{root}/rejects/sales")
        return (house.raw("sales").count(), [(r["sale_id"], r["missing_columns"]) for r in rows(rejects)],
                {r["sale_id"]: r["revenue"] for r in rows(house.core("sales"))}), house._current("sales")

    first, versions = run()
    assert first == (6, [("8", "total_cost")], {"1": 18, "2": 18, "7": 30})
    assert run() == (first, versions)  # the ledger names the batch: it is skipped
    monkeypatch.setattr(Ledger, "holds", lambda *_: False)  # as if it had died before its last step
    assert run()[0] == first


def test_incremental_rates_equal_the_batch_run(spark, landing, rate_files, tmp_path, rows):
    from shopledger.streaming.incremental import ingest_rates_available

    currencies = rates.read_currency_dim(spark, rate_files.daily)
    root, progress = str(tmp_path / "stream"), str(tmp_path / "progress")

    def run():
        ingest_rates_available(spark, rate_files.history, root, currencies, progress).awaitTermination()
        house = Warehouse(spark, root)
        return [{k: v for k, v in r.items() if k != "updated_at"} for r in
                rows(house.core("currency_rates"), "currency_code", "rate_date")], house.raw("currency_rates").count()

    stored, loaded = run()
    assert [(r["currency_code"], str(r["rate_date"]), r["rate_to_rub"]) for r in stored] == [
        ("CNY", "2024-12-02", 9.55), ("USD", "2024-12-01", 107.7409), ("USD", "2024-12-02", 106.1878)]
    assert loaded == 3 and run() == (stored, 3)
    (tmp_path / "history" / "later.xml").write_text(
        '<ValCurs ID="R01235"><Record Date="02.12.2024" Id="R01235"><Nominal>1</Nominal>'
        "<Value>110,5</Value></Record></ValCurs>", encoding="cp1251")
    after, loaded = run()
    assert loaded == 4 and after[2]["rate_to_rub"] == 110.5 and after[:2] == stored[:2]


def test_a_run_refreshes_the_marts_of_touched_months(spark, landing, tmp_path, monkeypatch):
    from shopledger.plans import published

    seen = []
    monkeypatch.setattr(published, "refresh", lambda tables, root, months: seen.append((root, months)))
    root = str(tmp_path / "w")
    ingest.run(spark, landing, root, marts="/marts", only_new=True)
    write(landing, "sales.csv", SALES_HEADER, sale(4, "2024-11-05"))
    ingest.run(spark, landing, root, marts="/marts", only_new=True)
    ingest.run(spark, landing, root, marts="/marts", only_new=True)
    # everything at first, then what the load names (stock and plans of December land again), then nothing
    assert seen == [("/marts", None), ("/marts", ("2024-11", "2024-12"))]
