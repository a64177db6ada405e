import random

import numpy as np
from brute import in_order, labelled, near_duplicates
from hypothesis import given, settings
from hypothesis import strategies as st

from shopledger.llm import order_minhash as O
from shopledger.llm import text as T


def found(df, **settings):
    return {r.doc_id: r.class_id for r in O.classes(df, **settings).collect()}


def edited(words, share, random):
    out = []
    for word in words:
        chance = random.random()
        if chance < share / 3:
            continue
        out.append(f"new{random.random()}" if chance < share else word)
    return out


def test_classes_of_edited_copies(spark):
    rng, rows = random.Random(5), []
    for family in range(12):
        base = [f"f{family}w{rng.randint(0, 60)}" for _ in range(rng.randint(20, 150))]
        for share in (0, 0, 0.005, 0.01, 0.02, 0.05, 0.2):
            rows.append((len(rows), " ".join(edited(base, share, rng))))
        half = len(base) // 2
        rows.append((len(rows), " ".join(base[half:] + base[:half])))  # same shingles, another order
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == near_duplicates(rows)


def test_pairs_that_the_central_node_does_not_link(spark):
    """Two families in the same buckets: only the comparison in blocks can link the second one."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base)) for i in range(2)]
    for i in range(30):
        far = list(base)
        for at in rng.sample(range(300), 14):
            far[at] = f"r{i}x{at}"
        rows.append((len(rows), " ".join(far)))
        far[rng.randrange(300)] = "z"
        rows.append((len(rows), " ".join(far)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == near_duplicates(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=40), st.floats(0.3, 1))
def test_link_is_the_alignment(a, b, similarity):
    def symbols(x):
        part = next(T.slices(__import__("pyarrow").array([" ".join(f"w{i}" for i in x)])))
        return O.shingles(T.words(part)[0], 2)

    x, y = (labelled(" ".join(f"w{i}" for i in s), 2) for s in (a, b))
    kept = in_order(x, y)
    expected = bool(x and y) and kept >= similarity * (len(x) + len(y) - kept) - 1e-9
    assert (bool(x and y) and O.linked(symbols(a), symbols(b), similarity)) == expected


def test_longest_increasing():
    assert O.increasing(np.array([3, 1, 2, 5, 4])) == 3 and O.increasing(np.array([], np.int64)) == 0


def test_odd_rows(odd):
    rows = O.classes(odd).collect()
    assert len(rows) == odd.count()
    classes = {}
    for r in rows:
        classes.setdefault(r.class_id, []).append(r)
    assert sorted(r.doc_id for r in classes[5]) == [5, 6, 6]
    assert sorted(r.doc_id for r in classes[7]) == [7, 8]
    for doc in (1, 2, 3, 4, 9, 10, 11, 12, None):
        assert [r.doc_id for r in rows if r.class_id == doc] == [doc]
    assert sum(r.kept for r in rows) == len(classes)
    assert all(r.class_size == len(classes[r.class_id]) for r in rows)
    assert O.classes(odd.limit(0)).collect() == []
