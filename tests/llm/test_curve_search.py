import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from shopledger.llm.curve_search import build, hilbert, search
from shopledger.llm.entry import op12_curve_search


def brute(rows, divisor, k):
    """Result by comparison of all; rows equal in id and vector count once."""
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v):
            kept[i, tuple(v)] = [*v]
    width = max((len(v) for v in kept.values()), default=0)
    padded = {key: np.array([*v, *[0.0] * (width - len(v))]) for key, v in kept.items()}
    out = []
    for q in padded:
        if q[0] % divisor == 0:
            others = sorted((float(np.sqrt(((padded[q] - padded[x]) ** 2).sum())), x[0]) for x in padded if x != q)
            out += [(q[0], rank, i, round(d, 9)) for rank, (d, i) in enumerate(others[:k], 1)]
    return sorted(out)


def result(spark, rows, divisor=5, kind="double", **settings):
    df = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], f"vec_id long, embedding array<{kind}>, v string, score int, rank int")
    found = search(df.repartition(3), f"vec_id % {divisor} = 0", **settings).select("query_id", "rank", "vec_id", "score").collect()
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found)


@pytest.mark.parametrize("dimensions, bits", [(1, 6), (2, 4), (3, 3), (5, 2)])
def test_curve_passes_each_cell_once_by_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    keys = hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_all_within_the_window(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(90)]
    rows += [(i + 90, rows[10][1]) for i in range(60)]  # equal vectors: ties, and more of them than results
    rows += [(20, rows[3][1]), (20, rows[3][1]), (150, [9.0] * 8)]  # an id with two vectors, one of them twice
    assert result(spark, rows, k=7, goal=1.0, probes=1000) == brute(rows, 5, 7)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.0, 0.0]),
        (6, [-0.01, 0.25]), (6, [-0.01, 0.25]), (7, [2.0]), (None, [1.0, 1.0]), (8, []), (10, [0.25, 0.25]), (10, [0.5, 0.25]),
    ]
    assert result(spark, rows, k=20) == brute(rows, 5, 20)
    assert result(spark, rows[:1]) == [] and result(spark, []) == [] and result(spark, rows[1:4]) == []
    assert len(result(spark, [(0, [1e300, 1e300]), (1, [-1e300, 0.0]), (5, [1.0, 1e-300])])) == 4


def test_windows_stay_small_where_vectors_lie_in_clusters(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + rng.normal(size=16) * 0.02).tolist()) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = build(df, "vec_id % 50 = 0")
    assert index.n == 6000 and index.window < 400
    found = search(df, "vec_id % 50 = 0", index=index).collect()
    true = {(q, x) for q, _, x, _ in brute(rows, 50, 10)}
    assert len(true & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(true)


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    table = pq.read_table(f"{sf}/embeddings.parquet")
    rows = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist()))
    true = brute(rows, 100, 10)
    found = {(r.query_id, r.vec_id): r.score for r in op12_curve_search(spark, sf).collect()}
    hits = [(q, x, d) for q, _, x, d in true if (q, x) in found]
    assert len(hits) >= 0.9 * len(true) and len(found) == len(true)
    assert all(abs(found[q, x] - d) < 1e-8 for q, x, d in hits)
