import random

import pytest
from brute import decontamination

from shopledger.llm.winnowing import scan


def result(documents, benchmark, **settings):
    rows = scan(documents, benchmark, **settings).select("doc_id", "n_words", "n_hit", "items").collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows), key=str)


def test_every_shared_window_is_found(spark):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(6)]  # few words: many ties and repeated grams
    text = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, text(random.choice([0, 3, 9, 10, 14, 40]))) for i in range(40)] + [(1, None), (2, "w1 w1"), (2, "w1 w1")]
    documents = [(i, text(random.randint(0, 80)) + " - " + random.choice(items)[1].__str__().upper()) for i in range(120)]
    got = result(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    expected = decontamination(documents, items)
    assert got == sorted(expected, key=str)
    assert any(r[2] for r in expected)


def test_odd_rows_and_empty_tables(spark, odd, odd_rows):
    items = [("q", odd_rows[7][1]), (None, "long long"), ("é", "")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    rows = [(d, t) for d, t, *_ in odd_rows]
    expected = decontamination(rows, [i for i in items if i[0]])
    known = {(d, n, h): i for d, n, h, i in result(odd, benchmark.where("item_id IS NOT NULL"))}
    assert known == {(d, n, h): i for d, n, h, i in expected}
    assert result(odd.limit(0), benchmark) == []
    assert all(r[2] == 0 and r[3] == [] for r in result(odd, benchmark.limit(0)))


def test_a_null_item_id_marks_words_but_names_no_item(spark):
    documents = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    assert result(documents, spark.createDataFrame([(None, "b c")], "item_id int, text string")) == [(1, 3, 2, [])]


def test_wrong_settings(odd):
    with pytest.raises(ValueError):
        scan(odd, odd, window=3, gram=4)


def test_words_that_a_polynomial_takes_for_one(spark):
    from test_text import complements

    one, other = complements(10)
    documents = spark.createDataFrame([(1, one), (2, f"x {other} y")], "doc_id long, text string")
    assert [r[2] for r in result(documents, spark.createDataFrame([(7, one)], "item_id long, text string"))] == [1, 0]
