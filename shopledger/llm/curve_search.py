"""Approximate nearest neighbours by several shifted Hilbert curves.

Vectors are projected to a few numbers for each curve, moved by a chance amount, put on a grid and ordered by their place on
the Hilbert curve through that grid; Spark sorts them by range. A query's candidates are the entries whose rank differs from
its own by at most `window` on some curve. Windows meet entries in blocks of neighbouring ranks; what the curves find is merged
and ranked by the distance between the original vectors.

The window is measured, not assumed: for `probes` entries the true neighbours are found by comparison with all others, and
the window is the least one that holds `goal` of these pairs on at least one curve. Where vectors lie in clusters it
stays small; where they have no structure it becomes a share of the table, since no ordering can do better.

Directions are random combinations of `sample` vectors less their mean, so that they follow the spread of the data; this sample
and the probes are the only bounded ones, all else covers every row. Entries are distinct vectors with the smallest ids of
their rows: any number of equal vectors is one entry, and more ids than a query can use aren't kept.

Defined cases: vectors that are null, empty, all zero, or hold null or non-finite components take no part, nor do null ids;
shorter vectors count as filled up with zeros; rows equal in id and vector count once; rows that share an id but differ are
queries and candidates of their own; ties go to the smaller id; a query with fewer than k candidates gets all; distances too
large for a double are infinite, in the order of ids among those found; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopledger.llm.scratch import saved
from shopledger.llm.vectors import matrix, usable

DIMENSIONS = 8
BITS = 7
BLOCK_ROWS = 4096
BLOCK_QUERIES = 2048
SALTS = 16


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole numbers below 2**bits."""
    x = np.ascontiguousarray(cells.T, np.int64)
    last = len(x) - 1
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for axis in range(len(x)):
            there = (x[axis] & high) != 0
            swap = np.where(there, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(there, low, swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[last] & (1 << bit)) != 0, (1 << bit) - 1, 0)
    x ^= flip
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            place = (place << 1) | ((x[axis] >> bit) & 1)
    return place


@dataclass
class Curves:
    """For each curve a projection, its centre and spread, and a shift."""

    centre: np.ndarray
    directions: np.ndarray
    spread: np.ndarray
    shift: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, curves: int, seed: int) -> Curves:
        random = np.random.default_rng(seed)
        centre = sample.mean(axis=0)
        around = sample - centre
        directions = random.normal(size=(curves, DIMENSIONS, len(sample))) @ around / np.sqrt(len(sample))
        with np.errstate(over="ignore", invalid="ignore"):
            spread = np.nan_to_num((around @ directions.reshape(-1, sample.shape[1]).T).std(axis=0))
        return cls(centre, directions, np.where(spread > 0, spread, 1).reshape(curves, DIMENSIONS),
                   random.uniform(size=(curves, DIMENSIONS)))

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """One row for each curve. The grid reaches four spreads to both sides and one more for the shift."""
        out = np.empty((len(self.shift), len(rows)), np.int64)
        for c, (directions, spread, shift) in enumerate(zip(self.directions, self.spread, self.shift)):
            at = np.nan_to_num((rows - self.centre) @ directions.T / spread)
            out[c] = hilbert(np.clip((at + 4 + shift) / 9 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)
        return out


@dataclass
class Index:
    """`entries`: entry, v, ids, is_query, ranks (one by curve). `window` holds `goal` of the probes' neighbours."""

    spark: SparkSession
    entries: DataFrame
    n: int
    width: int
    curves: int
    window: int
    k: int


def _rows(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Id and vector of the rows that take part."""
    nonzero = F.exists(vector_column, lambda x: x.cast("double") != 0)
    return vectors.where(F.col(id_column).isNotNull() & usable(vector_column) & nonzero).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))


def build(vectors: DataFrame, is_query: str, *, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10,
          curves: int = 8, goal: float = 0.95, sample: int = 2048, probes: int = 256, seed: int = 5) -> Index:
    """Every vector on every curve. `is_query` is SQL on `vec_id` that says which rows will ask."""
    spark = vectors.sparkSession
    asking = F.coalesce(F.expr(is_query), F.lit(False)).alias("asks")
    few = Window.partitionBy("v", "asks").orderBy("vec_id")
    # at most k others and the query itself: of equal vectors no more ids than these can be in a result
    entries = saved(
        _rows(vectors, id_column, vector_column).select("vec_id", "v", asking).distinct()
        .withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.slice(F.sort_array(F.collect_set("vec_id")), 1, k + 1).alias("ids"), F.max("asks").alias("is_query"))
        .select(F.monotonically_increasing_id().alias("entry"), "v", "ids", "is_query")
    )
    size = entries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not size.n:
        return Index(spark, entries.withColumn("ranks", F.array().cast("array<long>")), 0, 0, curves, 0, k)
    chosen = entries.orderBy(F.xxhash64("v"), "v").limit(sample).select("v").collect()
    known = Curves.fit(matrix(pa.array([r.v for r in chosen], pa.list_(pa.float64())), size.width, np.float64), curves, seed)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = known.keys(matrix(batch.column(1), size.width, np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(np.ascontiguousarray(found.T)), pa.list_(pa.int64()))], ["entry", "keys"])

    # sorted by range, numbered within each partition, then from partition to partition: no task sees a whole curve
    dealt = saved(
        entries.select("entry", "v").mapInArrow(keys, "entry long, keys array<long>")
        .select("entry", F.posexplode("keys").alias("curve", "key"))
        .repartitionByRange("curve", "key", "entry").sortWithinPartitions("curve", "key", "entry")
        .select("entry", "curve", F.monotonically_increasing_id().alias("number"))
    )
    part = F.shiftright("number", 33).alias("part")
    counts = dealt.groupBy(part).count().orderBy("part").collect()  # one row for each partition
    before, offsets = 0, []
    for row in counts:
        offsets.append((row.part, before))
        before += row["count"]
    offsets = F.broadcast(spark.createDataFrame(offsets, "part long, before long"))
    rank = F.col("before") + F.col("number").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("curve") * F.lit(size.n)
    ranked = (
        dealt.withColumn("part", part).join(offsets, "part").select("entry", F.struct("curve", rank.alias("rank")).alias("at"))
        .groupBy("entry").agg(F.sort_array(F.collect_list("at"))["rank"].alias("ranks"))
    )
    placed = saved(entries.join(ranked, "entry"))
    window = _window(placed, size.n, size.width, k, goal, probes)
    return Index(spark, placed, size.n, size.width, curves, window, k)


def _window(placed: DataFrame, n: int, width: int, k: int, goal: float, probes: int) -> int:
    """The least window that holds `goal` of the true neighbours of `probes` entries on some curve."""
    asked = placed.orderBy(F.xxhash64("v", "entry"), "entry").limit(probes).select("entry", "v", "ranks").collect()
    own = np.array([r.entry for r in asked])
    rows = matrix(pa.array([r.v for r in asked], pa.list_(pa.float64())), width, np.float64)
    ranks = np.array([r.ranks for r in asked], np.int64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            entry, others = batch.column(0).to_numpy(), matrix(batch.column(1), width, np.float64)
            places = matrix(batch.column(2), ranks.shape[1], np.int64)
            squares = _squares(rows, others)
            squares[own[:, None] == entry] = np.inf
            best = np.argpartition(squares, min(k, len(entry)) - 1, axis=1)[:, :k]
            for i, picked in enumerate(best):
                picked = picked[entry[picked] != own[i]]
                away = np.abs(places[picked] - ranks[i]).min(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(picked), i, np.int64)), pa.array(squares[i, picked]), pa.array(away)],
                    ["probe", "square", "away"])

    nearest = Window.partitionBy("probe").orderBy("square", "away")
    found = placed.select("entry", "v", "ranks").mapInArrow(compare, "probe long, square double, away long")
    away = [r.away for r in found.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k).select("away").collect()]
    return min(n, max(k + 1, int(np.ceil(np.quantile(away, goal, method="higher"))))) if away else n


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        found = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)
    return np.nan_to_num(np.maximum(found, 0), nan=np.inf, posinf=np.inf)


def _within(queries: np.ndarray, query_ranks: np.ndarray, rows: np.ndarray, ranks: np.ndarray, window: int,
            k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and distance of the k nearest rows inside each query's window, and of rows as near as the last."""
    squares = _squares(queries, rows)
    squares[np.abs(query_ranks[:, None] - ranks) > window] = np.nan  # sorts last
    size = np.maximum((queries**2).sum(axis=1), 1)[:, None] + (rows**2).sum(axis=1)
    if rows.shape[0] > k:
        last = np.partition(squares, k - 1, axis=1)[:, k - 1 : k]
        keep = (squares <= last + 1e-12 * size) | (np.isnan(last) & ~np.isnan(squares))
    else:
        keep = ~np.isnan(squares)
    query, row = np.nonzero(keep)
    with np.errstate(over="ignore"):
        distance = np.sqrt(((queries[query] - rows[row]) ** 2).sum(axis=1))
    return query, row, distance


def search(vectors: DataFrame, is_query: str, *, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10,
           index: Index | None = None, **settings) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row that fulfils `is_query` (SQL on `vec_id`)."""
    index = index or build(vectors, is_query, id_column=id_column, vector_column=vector_column, k=k, **settings)
    if not index.n:
        return index.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    block = max(1, min(BLOCK_ROWS, max(1024, index.window)))
    blocks = -(-index.n // block)
    asking = index.entries.where("is_query").count()
    portions = max(1, -(-asking * min(index.n, 2 * index.window + block) // (index.n * BLOCK_QUERIES)))
    on_curves = F.posexplode("ranks").alias("curve", "rank")
    rows = (
        index.entries.select("entry", "v", "ids", on_curves)
        .withColumn("block", F.floor(F.col("rank") / block))
        .withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(portions - 1).cast("long"))))
    )
    queries = (
        index.entries.where("is_query").select(F.col("entry").alias("query"), F.col("v").alias("asked"), on_curves)
        .withColumn("block", F.explode(F.sequence(
            F.floor(F.greatest(F.col("rank") - index.window, F.lit(0)) / block),
            F.floor(F.least(F.col("rank") + index.window, F.lit(index.n - 1)) / block))))
        .withColumn("portion", F.pmod(F.xxhash64("query"), F.lit(portions)))
    )
    width, window, most = index.width, index.window, index.k + 1

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()),
                             "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())})
        query, row, score = _within(
            matrix(right["asked"], width, np.float64), right["rank"].to_numpy(),
            matrix(left["v"], width, np.float64), left["rank"].to_numpy(), window, most)
        return pa.table({"query": right["query"].take(query), "entry": left["entry"].take(row), "ids": left["ids"].take(row),
                         "score": pa.array(score, pa.float64())})

    keys = ("curve", "block", "portion")
    met = rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        meet, "query long, entry long, ids array<long>, score double")
    # the same entry may come from several curves: one exchange by query serves the merge and both rankings
    by_entry = Window.partitionBy("query").orderBy("score", F.col("ids")[0], "entry")
    by_id = Window.partitionBy("query").orderBy("score", "vec_id", "entry")
    best = (
        met.withColumn("place", F.dense_rank().over(by_entry)).where(F.col("place") <= most)
        .dropDuplicates(["query", "entry"])
        .select("query", "entry", "score", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= most)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    )
    # rows that ask with one and the same vector share an answer; salted, since they may be very many
    answers = (
        index.entries.where("is_query").join(best, F.col("entry") == F.col("query")).select("v", "found")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    )
    asked = (
        _rows(vectors, id_column, vector_column).where(F.expr(is_query)).select(F.col("vec_id").alias("query_id"), "v")
        .distinct().withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)))
    )
    own = F.slice(F.filter("found", lambda x: (x["vec_id"] != F.col("query_id")) | (x["score"] > 0)), 1, k)
    return (
        asked.join(answers, ["salt", "v"]).select("query_id", F.posexplode(own).alias("rank", "hit"))
        .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
