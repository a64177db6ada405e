"""Plans and sales of the star schema from one sum by cell, and the reports on them."""

import pytest

from shopledger.plans import narratives, plan_fact, reports
from shopledger.sources.star_schema import StarSchemaTables

LINES = """
    -- order, line, part, store, day, price, discount, quantity
    (1, 1, 1, 1, '1996-02-29', 100.05, 0.05, 3), (1, 1, 1, 2, '1996-02-28', 1.0, 0.0, 9),
    (1, 2, 1, 1, '1996-02-01', 0.3, 0.0, 1), (2, 1, 1, 1, '1997-02-10', 10.0, 0.1, 2),
    (2, 2, 2, 1, '1997-02-11', 7.77, 0.0, 5), (3, 1, 3, 1, '1997-02-11', 8.0, 0.0, 5),
    (3, 2, 3, 1, '1998-02-11', 9.0, 0.0, 5), (4, 1, 1, 100000, '1996-05-05', 0.1, 0.0, 1),
    (4, 2, 1, 1000000, '1996-05-06', 0.1, 0.0, 1), (4, 3, 1, 1000000, '1997-05-06', 5.0, 0.0, 1),
    (5, 1, 1, NULL, '1996-05-06', 5.0, 0.0, 1), (5, 2, 1, NULL, '1997-05-06', 6.0, 0.0, 1),
    (5, 3, 1, 7, NULL, 6.0, 0.0, 1), (6, 1, 1, 7, '1995-01-31', NULL, 0.0, NULL),
    (6, 2, 1, 7, '1996-01-01', 4.0, 0.0, 2), (7, 1, 9, 7, '1996-01-01', 4.0, 0.0, 2),
    (7, 2, 4, 7, '1996-01-01', -4.1, 0.0, 2), (7, 3, 4, 7, '1997-01-01', 2.0, 0.0, 2)"""


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("star")
    spark.sql(f"""
        SELECT CAST(o AS BIGINT) AS l_orderkey, n AS l_linenumber, CAST(p AS BIGINT) AS l_partkey,
               CAST(s AS BIGINT) AS l_suppkey, CAST(d AS TIMESTAMP) AS l_shipdate,
               CAST(e AS DOUBLE) AS l_extendedprice, CAST(c AS DOUBLE) AS l_discount,
               CAST(q AS DOUBLE) AS l_quantity
        FROM VALUES {LINES} AS t(o, n, p, s, d, e, c, q)""").write.parquet(str(root / "lineitem.parquet"))
    spark.sql("SELECT * FROM VALUES (1L, 'Tea'), (1L, 'Tea'), (2L, 'Cake'), (3L, NULL), (4L, 'Jam')"
              " AS t(p_partkey, p_type)").write.parquet(str(root / "part.parquet"))
    spark.sql("SELECT 1L AS o_orderkey, '1-URGENT' AS o_orderpriority").write.parquet(str(root / "orders.parquet"))
    return StarSchemaTables(spark, str(root))


def plain_tables(star):
    """The same tables without a way of their own to align plans and sales."""
    return {name: star[name] for name in ("sales", "plan_sales")}


@pytest.mark.parametrize("months", [None, ["1997-02"], ["1996-05", "1997-05"], []])
def test_cells_of_the_star_equal_those_of_its_tables(star, months):
    expected = plan_fact.cells(plain_tables(star), months)
    got = plan_fact.cells(star, months).select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("report", [reports.report_monthly, reports.report_plan_fact, narratives.facts_monthly])
def test_reports_of_the_star_equal_those_of_its_tables(star, report):
    assert sorted(map(str, report(star).collect())) == sorted(map(str, report(plain_tables(star)).collect()))


@pytest.mark.parametrize("report", [reports.report_monthly, narratives.facts_monthly])
def test_lines_are_read_for_plans_and_sales_at_once(star, report):
    plan = report(star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("/lineitem.parquet") + plan.count("Relation [l_") == 1
    assert "RepartitionByExpression [store_id" in plan


def test_completions_are_taken_of_listed_rows(star):
    plan = reports.report_monthly(star)._jdf.queryExecution().optimizedPlan().toString()
    # quotients stand above the ranking, and entries are cut from arrays without a lambda
    assert "rint(" not in plan.split("Window [row_number()")[1]
    assert "filter(array(" not in plan


def test_amounts_equal_in_doubles_are_ranked_exactly(spark):
    rows = spark.sql("""
        SELECT '2024-12' AS month, 1 AS level, 1L AS sales_count, 0L AS plan_cells, id AS store_id, NULL AS category,
               CAST(r AS DECIMAL(24,2)) AS revenue, 0 AS profit, 0 AS quantity, NULL AS plan_revenue,
               NULL AS plan_profit, NULL AS plan_qty, CAST(0 AS DECIMAL(24,2)) AS fact_revenue,
               CAST(0 AS DECIMAL(24,2)) AS fact_profit, 0 AS fact_qty
        FROM VALUES ('a', '9007199254740993.01'), ('b', '9007199254740993.03'), ('c', '9007199254740993.02'),
                    ('d', NULL), ('e', '-1') AS t(id, r)""")
    parts = {"low": reports._ranked(reports._STORE, reports.STORE_FIELDS, False)}
    [row] = reports._folded(rows, parts, 4).collect()
    assert [e.store_id for e in row.low] == ["e", "a", "c", "b"]
