import re

from brute import line_dedup

from shopledger.llm.line_dedup import Runs, dedup


def result(df, **settings):
    rows = dedup(df, **settings).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted(map(tuple, rows), key=str)


def test_as_brute_force_on_odd_rows(odd, odd_rows):
    rows = [(-1 if d is None else d, t) for d, t, *_ in odd_rows]  # a null id is the smallest
    expected = [(None if d == -1 else d, *rest) for d, *rest in line_dedup(rows)]
    assert result(odd) == sorted(expected, key=str)
    assert result(odd, batches=7, fanout=3) == result(odd)


def test_case_folds_for_ascii_only(spark):
    rows = [(i, t * 20) for i, t in enumerate(["É", "é", "É", "É"])]
    assert result(spark.createDataFrame(rows, "doc_id int, text string")) == sorted(line_dedup(rows), key=str)


def test_empty_table(odd):
    assert dedup(odd.limit(0)).collect() == []


def test_runs_are_merged_by_level_and_hold_a_key_once(spark):
    runs = Runs(spark, fanout=2, buckets=2)
    for batch in range(5):
        rows = [(key, key, 1, batch) for key in range(batch, batch + 3)]
        runs.add(spark.createDataFrame(rows, "h1 long, h2 long, docs long, last long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r.h1 for r in runs._entries().collect()) == list(range(7))
    total = {r.h1: (r.docs, r.last) for r in runs.totals(2).collect()}
    assert total == {1: (2, 1), 2: (3, 2), 3: (3, 3), 4: (3, 4), 5: (2, 4)}


def test_no_python_in_the_plan(odd):
    plan = dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_no_table_is_left_in_the_catalog(spark, odd):
    before = {t.name for t in spark.catalog.listTables()}
    assert dedup(odd).count() == odd.count()
    assert {t.name for t in spark.catalog.listTables()} == before
