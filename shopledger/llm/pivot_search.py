"""Exact top-k search by inner product with elimination by a table of pivot distances.

The distances of every vector to a fixed number of pivots are computed once. By the triangle inequality |d(q,p) - d(x,p)| is
at most d(q,x) for each pivot p; with the largest of these, L, the score q.x = (|q|^2 + |x|^2 - d(q,x)^2) / 2 is at most
(|q|^2 + |x|^2 - L^2) / 2. A query takes candidates with the best bounds first and stops where the bound falls below its k-th
best score, which begins at the k-th best among the pivots. Nothing better can follow, so the result is exact.

Vectors and queries meet in blocks of bounded size. Components are floor(scale * x), kept within 64 bits. Defined cases: vectors that are null or
hold null or non-finite components take no part; shorter vectors count as padded with zeros; a row is known by its id, and
of rows sharing one the smallest vector counts; ties go to the smaller id; a query with fewer than k candidates gets all;
null ids take no part; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.scratch import saved

BLOCK_ROWS = 8192
BLOCK_QUERIES = 4096
QUERIES_AT_ONCE = 64
_FLOAT_EXACT = 2.0**53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, kept within 64 bits."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < _FLOAT_EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a).dot(whole(b).T), -(2**63), 2**63 - 1).astype(np.int64)


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One row per pivot."""
    out = np.empty((len(pivots), len(vectors)), np.float32)
    for i, pivot in enumerate(pivots):
        out[i] = np.sqrt(((vectors - pivot) ** 2).sum(axis=1))
    return out


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(rows) > k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        rows, scores = rows[keep], scores[keep]
    order = np.lexsort((ids[rows], -scores))[:k]
    return rows[order], scores[order]


def nearest(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, pivots: np.ndarray,
            pivot_ids: np.ndarray, k: int) -> list[np.ndarray]:
    """For each query the rows of its k best candidates in this block, or fewer where others are certainly better.

    The candidates with the best bounds are evaluated first. Their k-th score is where the search may stop: of the rest,
    those whose bound reaches it are evaluated too. If these are most of the block, as where the pivots tell vectors apart
    badly, one matrix product for several queries is cheaper than picking them out.
    """
    far, near = distances(vectors, pivots), distances(queries, pivots)
    query_norms, norms = (queries**2).sum(axis=1), (vectors**2).sum(axis=1)
    by_pivot = products(queries, pivots)
    found = []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        part = slice(at, at + QUERIES_AT_ONCE)
        own = queries[part]
        least = np.zeros((len(own), len(vectors)), np.float32)
        for p in range(len(pivots)):
            np.maximum(least, np.abs(far[p] - near[p, part, None]), out=least)
        sums = query_norms[part, None] + norms
        # a little more than the bound, for what rounding may have taken from it
        bound = (sums - np.square(least, dtype=np.float64)) / 2 + 1e-5 * (1 + sums)
        bound[query_ids[part, None] == ids] = -np.inf
        promising, floors, alive = [], [], np.zeros(bound.shape, bool)
        for i in range(len(own)):
            known = np.sort(by_pivot[at + i][pivot_ids != query_ids[at + i]])[::-1]
            rows = np.flatnonzero(bound[i] >= (known[k - 1] if len(known) >= k else np.finfo(float).min))
            if len(rows) > 4 * k:
                rows = rows[np.argpartition(-bound[i, rows], 4 * k)[: 4 * k]]
            best = _best(rows, products(own[i : i + 1], vectors[rows])[0], ids, k)
            promising.append((rows, best))
            floors.append(best[1][-1] if len(best[0]) == k else known[k - 1] if len(known) >= k else np.finfo(float).min)
            alive[i] = bound[i] >= floors[-1]
            alive[i, rows] = False
        rest = alive.sum()
        whole = products(own, vectors) if rest > alive.size / 8 else None
        for i, (_, (best_rows, best)) in enumerate(promising):
            rows = np.flatnonzero(alive[i])
            if len(rows):
                scores = products(own[i : i + 1], vectors[rows])[0] if whole is None else whole[i, rows]
                best_rows, best = _best(np.concatenate([best_rows, rows]), np.concatenate([best, scores]), ids, k)
            found.append(np.stack([best_rows, best]))
    return found


def search(vectors: DataFrame, is_query: str, *, id_column: str = "vec_id", vector_column: str = "embedding",
           k: int = 20, scale: float = 64, pivots: int = 32) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row that fulfils `is_query` (SQL on `vec_id`)."""
    spark = vectors.sparkSession
    numbers = F.transform(F.col(vector_column), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fine = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = saved(
        vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & fine)
        .select(F.col(id_column).cast("long").alias("vec_id"), numbers.alias("v"))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )
    sizes = whole.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count(F.when(F.expr(is_query), 1)).alias("q")).first()
    width, blocks, query_blocks = sizes.width or 0, max(1, -(-sizes.n // BLOCK_ROWS)), max(1, -(-sizes.q // BLOCK_QUERIES))
    chosen = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    pivot_ids = np.array([r.vec_id for r in chosen], np.int64)
    pivot_rows = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        pivot_rows[i, : len(r.v)] = r.v

    def matrix(table: pa.Table) -> np.ndarray:
        lists = table["v"].combine_chunks()
        ends = np.asarray(lists.offsets)
        out = np.zeros((len(lists), width))
        values, size = np.asarray(lists.values), np.diff(ends)
        row = np.repeat(np.arange(len(lists)), size)
        out[row, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], size)] = values[ends[0] : ends[-1]]
        return out

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = ([], [], [])
        if len(left) and len(right):
            ids, query_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            found = nearest(matrix(right), query_ids, matrix(left), ids, pivot_rows, pivot_ids, k)
            columns = (
                np.repeat(query_ids, [x.shape[1] for x in found]),
                ids[np.concatenate([x[0] for x in found]).astype(np.int64)],
                np.concatenate([x[1] for x in found]),
            )
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    def copies(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # a query goes to every block of vectors, a vector to every block of queries: both blocks have a bounded size
    data = whole.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).withColumn("query_block", copies(query_blocks))
    queries = (
        whole.where(F.expr(is_query))
        .withColumn("query_block", F.pmod(F.xxhash64(F.lit(1), F.col("vec_id")), F.lit(query_blocks)))
        .withColumn("block", copies(blocks)).select("vec_id", "v", "block", "query_block")
    )
    found = (
        data.groupBy("block", "query_block").cogroup(queries.groupBy("block", "query_block"))
        .applyInArrow(meet, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
