import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from shopledger.llm.product_codes import Codebooks, compress

LONG = "vec_id long, embedding array<double>, label int, error string, v long, n int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codes by comparison with every entry; rows: (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // parts)
    whole = []
    for i, v, label in kept:
        v = [math.floor(scale * x) for x in v] + [0] * (width * parts - len(v))
        whole.append((i, [v[p * width : (p + 1) * width] for p in range(parts)], label))
    seeds = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    book = [[r[1][p] for r in seeds] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, v: min(range(len(book[p])), key=lambda e: (away(v, book[p][e]), e))
    for _ in range(rounds):
        groups = [[[] for _ in book[p]] for p in range(parts)]
        for _, v, _ in whole:
            for p in range(parts):
                groups[p][near(p, v[p])].append(v[p])
        book = [[[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(groups[p], book[p])] for p in range(parts)]
    out = []
    for i, v, label in whole:
        codes = [near(p, v[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e in codes), sum(away(v[p], book[p][e]) for p, e in enumerate(codes)), label))
    sums = {}
    for _, _, error, label in out:
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    return sorted(((i, c, e, min(sums[label], 2**63 - 1)) for i, c, e, label in out), key=str), digest


def result(spark, rows):
    df = spark.createDataFrame([(*r, "e", 1, 2) for r in rows], LONG).repartition(3)
    found = compress(df)
    return sorted(map(tuple, found.rows.select("vec_id", "code", "error", "label_error").collect()), key=str), found.sha256


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=24).round(2).tolist(), int(i % 3)) for i in rng.permutation(120)]
    rows += [(200 + i, rows[5][1], None) for i in range(30)]  # equal vectors and one null label
    assert result(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = [
        (3, [1.0, -0.5], 1), (1, None, 1), (2, [None, 1.0], 1), (4, [float("nan")], 1), (5, [float("inf"), 1.0], 1), (6, [], None),
        (7, [0.25] * 9, None), (7, [0.125] * 9, 2), (7, [0.125] * 9, 2), (None, [-0.00001] * 3, 2), (8, [0.0] * 9, 3),
    ]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[1:3]) == ([], hashlib.sha256(b"").hexdigest()) and result(spark, [])[0] == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e5 * (i % 7), 3.0 - i, 1e3 * i, 0.5 * i, 2.0, 1.0, 0.0, -1e5], i % 2) for i in range(40)]
    assert result(spark, rows) == brute(rows)


def test_rare_and_hot_labels(spark):
    rows = [(i, [0.01 * i, 0.5], 0 if i % 3 else i) for i in range(60)]
    assert result(spark, rows) == brute(rows)
    from shopledger.llm import product_codes
    share, product_codes.HOT_SHARE = product_codes.HOT_SHARE, 4  # labels below a quarter of the rows are joined instead
    try:
        assert result(spark, rows) == brute(rows)
    finally:
        product_codes.HOT_SHARE = share


def test_walks_end_early_and_ties_go_to_the_lower_entry():
    rng = np.random.default_rng(9)
    centres = rng.integers(-100_000, 100_000, (8, 16, 4))
    books = Codebooks.of(centres)
    rows = centres[np.arange(8), rng.integers(0, 16, (5000, 8))] + rng.integers(-50, 50, (5000, 8, 4))
    entry, square, looked = books.nearest(rows.reshape(5000, 32))
    every = ((rows[:, :, None] - centres) ** 2).sum(axis=3)
    assert (entry == every.argmin(axis=2)).all() and (square == every.min(axis=2)).all()
    assert looked < 0.75 * 5000 * 8 * 16
    same = Codebooks.of(np.array([[[4], [0], [2], [0], [-2]]]))
    assert same.nearest(np.array([[1], [0], [3], [-1]]))[0].ravel().tolist() == [1, 1, 0, 1]


def test_columns_of_other_names(spark):
    df = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("x") for c in ("code", "error", "label_error", "same", "n", "width", "v")})
    assert compress(df).rows.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert compress(df).rows.first().code == "00" * 8
