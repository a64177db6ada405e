import math

import numpy as np

from shopledger.llm.pivot_search import nearest, products, search


def brute(rows, divisor, k):
    known = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = [math.floor(64 * x) for x in v]
        known[i] = min(known.get(i, own), own)
    out = []
    for q in sorted(known):
        if q % divisor == 0:
            scored = sorted((-sum(a * b for a, b in zip(known[q], known[x])), x) for x in known if x != q)
            out += [(q, rank, x, -s) for rank, (s, x) in enumerate(scored[:k], 1)]
    return out


def result(spark, rows, kind="float", **settings):
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], f"vec_id long, embedding array<{kind}>, v string, score int").repartition(3)
    return sorted(map(tuple, search(df, "vec_id % 5 = 0", **settings).select("query_id", "rank", "vec_id", "score").collect()))


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(150)]
    rows += [(i + 150, rows[7][1]) for i in range(40)]  # equal vectors: ties
    assert result(spark, rows, "double", k=7, pivots=12) == brute(rows, 5, 7)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.0, 0.0]),
        (6, [-0.01, 0.25]), (6, [-0.01, 0.25]), (7, [2.0]), (None, [1.0, 1.0]), (8, []), (10, [0.25, 0.25]), (10, [0.5, 0.25]),
    ]
    assert result(spark, rows, k=20) == brute(rows, 5, 20)
    assert result(spark, rows[:1]) == [] and result(spark, []) == []


def test_large_numbers_stay_exact():
    a = np.array([[2.0**40, 3.0]])
    assert products(a, a).tolist() == [[2**63 - 1]] and products(a, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 3]]


def test_elimination_looks_at_few(monkeypatch):
    from shopledger.llm import pivot_search

    rng = np.random.default_rng(1)
    centers = rng.normal(size=(20, 16)) * 600
    vectors = np.floor(np.repeat(centers, 200, axis=0) + rng.normal(size=(4000, 16)) * 5)
    vectors *= 1000 / np.sqrt((vectors**2).sum(axis=1))[:, None]
    vectors = np.floor(vectors)
    ids, seen = np.arange(4000), []
    pivots = vectors[::100]

    def counting(a, b, plain=pivot_search.products):
        seen.append(len(b))
        return plain(a, b)

    monkeypatch.setattr(pivot_search, "products", counting)
    (found,) = nearest(vectors[:1], ids[:1], vectors, ids, pivots, ids[::100], 10)
    scores = vectors @ vectors[0]
    expected = sorted((-int(s), i) for i, s in enumerate(scores) if i)[:10]
    assert [(-int(s), int(r)) for r, s in found.T] == expected
    assert sum(seen) < 1500
