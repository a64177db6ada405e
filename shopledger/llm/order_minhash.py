"""Near-duplicate documents by Order MinHash and banded alignment.

A document is the sequence of its shingles of five words (of all its words if it has fewer), each labelled with its number
among equal ones, so that no symbol occurs twice. A sketch takes the `picked` shingles with the smallest hashes, leaves them
in text order and hashes the result; documents that agree in one of `sketches` sketches meet in a bucket. Two documents of a
bucket are linked if an alignment of their sequences keeps enough of them in order: with L kept of m and n symbols,
L / (m + n - L) must reach the similarity. Such an alignment shifts no symbol by more than (m + n)(1 - s)/(1 + s) places,
so only that band is searched; as symbols are unique, L is the longest increasing run of positions. At similarity 0.8 a pair
agrees in one sketch with a chance near 0.8 ** 3, so 16 sketches miss about one pair in a hundred thousand.

Equal word sequences are one node from the start. In a bucket every node is first compared with the node that shares most
bucket-mates with others; whoever isn't in its class then is compared with all of the bucket, in blocks of bounded size, so
no pair of different classes goes uncompared and a large group of copies costs one comparison each.

Defined cases: null and wordless texts are like nothing else, not even like each other; equal rows and equal word sequences
share a class; a class is named by its smallest document id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm import text as T
from shopledger.llm.components import components
from shopledger.llm.scratch import saved

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 16
PICKED = 3
BLOCK = 256  # nodes, or
BLOCK_SHINGLES = 500_000  # shingles of a bucket that are compared in one go with as many others
_LABEL = np.uint64(0xA0761D6478BD642F)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Labelled shingle hashes in text order."""
    g = T.grams(words, min(size, len(words))) if len(words) else words
    order = np.argsort(g, kind="stable")
    ranked = g[order]
    first = np.ones(len(g), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    if first.all():
        return g
    place = np.arange(len(g))
    number = place - np.maximum.accumulate(np.where(first, place, 0))
    out = g.copy()
    out[order] = np.where(number > 0, T.mixed(ranked + number.astype(np.uint64) * _LABEL), ranked)
    return out


def sketch(symbols: np.ndarray, sketches: int, picked: int) -> np.ndarray:
    """One hash per sketch, of the symbols with the smallest hashes in text order."""
    seeds = T.mixed(np.arange(1, sketches + 1, dtype=np.uint64))
    n = min(picked, len(symbols))
    rows = max(1, (1 << 18) // len(symbols))
    out = []
    for at in range(0, sketches, rows):
        seed = seeds[at : at + rows]
        order = np.argpartition(T.mixed(symbols[None, :] ^ seed[:, None]), n - 1, axis=1)[:, :n]
        order.sort(axis=1)
        key = seed.copy()
        for i in range(n):
            key = T.mixed(key ^ symbols[order[:, i]])
        out.append(key)
    return np.concatenate(out)


def increasing(values: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    if np.all(values[1:] > values[:-1]):
        return len(values)
    tails: list[int] = []
    for value in values.tolist():
        at = bisect_left(tails, value)
        tails[at : at + 1] = [value]
    return len(tails)


def linked(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether an alignment in the band reaches the similarity."""
    both = len(a) + len(b)
    needed = similarity * both / (1 + similarity) - 1e-9
    if min(len(a), len(b)) < needed:
        return False
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(at) < needed:
        return False
    near = np.abs(at - to) <= both * (1 - similarity) / (1 + similarity)
    at, to = at[near], to[near]
    return len(at) >= needed and increasing(to[np.argsort(at)]) >= needed


def _scan(size: int, sketches: int, picked: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(2)):
                words, _, first = T.words(part)
                one = T.span_hashes(words, first[:-1], first[1:])
                two = T.span_hashes(T.mixed(words ^ _LABEL), first[:-1], first[1:])
                nodes, counts, keys = [], [], []
                for i in range(part.rows):
                    own = words[first[i] : first[i + 1]]
                    if len(own):
                        symbols = shingles(own, size)
                        nodes.append(one[i].tobytes() + two[i].tobytes())
                        counts.append(len(symbols))
                        keys.append(sketch(symbols, sketches, picked).view(np.int64))
                    else:
                        nodes.append(None)
                        counts.append(0)
                        keys.append(np.zeros(0, np.int64))
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.rows), batch.column(1).slice(part.first, part.rows),
                        pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys))),
                    ],
                    ["doc_id", "text_hash", "node", "n", "keys"],
                )

    return run


def _symbols(column: pa.Array, size: int) -> list[np.ndarray]:
    out = []
    for part in T.slices(column):
        words, _, first = T.words(part)
        out += [shingles(words[a:b], size) for a, b in zip(first, first[1:])]
    return out


def _verify(size: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # few texts as symbols at a time
                rows = batch.slice(at, 256)
                pairs = zip(_symbols(rows.column(2), size), _symbols(rows.column(3), size))
                keep = pa.array([linked(a, b, similarity) for a, b in pairs], pa.bool_())
                yield rows.select([0, 1]).filter(keep)

    return run


def _compare_block(size: int, similarity: float):
    """Links between the members of a block pair that are of different classes; members marked `rest` against all."""

    def run(table: pa.Table) -> pa.Table:
        symbols = _symbols(table["text"].combine_chunks(), size)
        nodes, classes = table["node"].to_pylist(), table["class"].to_pylist()
        rest = np.asarray(table["rest"].to_pylist(), bool)
        shared = np.zeros((len(nodes), len(nodes)), np.int32)
        owner = np.repeat(np.arange(len(nodes)), [len(s) for s in symbols])
        every = np.concatenate(symbols)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        ends = np.append(starts[1:], len(every))
        for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            holders = owner[a:b]
            shared[holders[:, None], holders] += 1
        sizes = np.array([len(s) for s in symbols])
        both = sizes[:, None] + sizes
        likely = (shared * (1 + similarity) >= similarity * both - 1e-9) & rest[:, None]
        parent = {c: c for c in classes}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        found = []
        for i, j in zip(*np.nonzero(likely)):
            a, b = root(classes[i]), root(classes[j])
            if a != b and linked(symbols[i], symbols[j], similarity):
                parent[a] = b
                found.append((nodes[i], nodes[j]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return run


def classes(documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
            similarity: float = SIMILARITY, sketches: int = SKETCHES, picked: int = PICKED) -> DataFrame:
    """One row per document: doc_id, text_hash (Spark's xxhash64 of the text), class_id, class_size, kept.

    `kept` marks one row of each class, with the class's smallest id; among equal rows it is any one of them.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0, at most 1")
    ids = documents.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_hash"), F.col(text_column).alias("text")
    )
    id_type = ids.schema["doc_id"].dataType.simpleString()
    rows = saved(
        ids.mapInArrow(
            _scan(shingle, sketches, picked), f"doc_id {id_type}, text_hash long, node binary, n long, keys array<long>"
        ).withColumn("row", F.monotonically_increasing_id())
    )
    nodes = saved(
        rows.where("node IS NOT NULL").groupBy("node")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("n").alias("n"), F.min("keys").alias("keys"))
    )
    sketched = nodes.select("node", "n", F.posexplode("keys").alias("sketch", "key")).withColumn("bucket", F.xxhash64("sketch", "key"))
    # written, so that the rows of a very large bucket can be split over tasks when they get its size
    sizes = saved(sketched.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
    members = saved(sketched.join(sizes, "bucket").select("bucket", "size", "node", "n"))
    mates = members.groupBy("node").agg(F.sum("size").alias("mates"))
    central = saved(
        members.join(mates, "node").groupBy("bucket")
        .agg(F.max(F.struct("mates", "node", "n")).alias("c"))
        .select("bucket", F.col("c.node").alias("center"), F.col("c.n").alias("center_n"))
    )
    stars = (
        members.join(central, "bucket").where("node <> center")
        .where(F.least("n", "center_n") >= similarity * F.greatest("n", "center_n") - 1e-9)
        .select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    )
    candidates = members.select("node").distinct().join(nodes, "node").select("node", "first.doc_id", "first.text_hash")
    texts = saved(
        ids.join(
            candidates.withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"}),
            F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")),
        ).select("node", "text").groupBy("node").agg(F.min("text").alias("text"))
    )
    with_texts = (
        stars.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    links = saved(with_texts.mapInArrow(_verify(shingle, similarity), "a binary, b binary"))
    grouped = saved(components(links))
    more = _rest_links(members, central, grouped, texts, shingle, similarity)
    if more is not None:
        grouped = saved(components(links.unionByName(more)))
    classed = nodes.join(grouped, "node", "left").select(
        "node", F.coalesce("component", "node").alias("class"), F.col("first.doc_id").alias("least_id")
    )
    in_class = rows.join(classed.select("node", "class"), "node", "left")
    # rows without words: a class each
    in_class = in_class.withColumn(
        "class", F.coalesce("class", F.concat(F.lit("row").cast("binary"), F.col("row").cast("string").cast("binary")))
    )
    # written, so that the rows of a very large class can be split over tasks when they get its name
    named = saved(in_class.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"),
        F.min(F.struct("doc_id", "row"))["row"].alias("kept_row"),
    ))
    return in_class.join(named, "class").select(
        "doc_id", "text_hash", "class_id", "class_size", (F.col("row") == F.col("kept_row")).alias("kept")
    )


def _rest_links(members: DataFrame, central: DataFrame, grouped: DataFrame, texts: DataFrame, shingle: int,
                similarity: float) -> DataFrame | None:
    """Links between members of one bucket that the comparison with its central node has left in different classes.

    None if there are none.
    """
    own = grouped.select("node", F.col("component").alias("class"))
    of_center = own.select(F.col("node").alias("center"), F.col("class").alias("center_class"))
    centers = central.join(of_center, "center", "left").select(
        "bucket", F.coalesce("center_class", "center").alias("center_class")
    )
    marked = saved(
        members.join(own, "node", "left").withColumn("class", F.coalesce("class", "node"))
        .join(centers, "bucket").withColumn("rest", F.col("class") != F.col("center_class"))
        .select("bucket", "size", "node", "n", "class", "rest")
    )
    # buckets of the same few members are looked at once
    unfinished = marked.groupBy("bucket", "size").agg(
        F.max("rest").alias("rest"), F.sum("n").alias("shingles"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.hash("node").cast("long")).alias("y")
    ).where("rest")
    unfinished = saved(unfinished)
    if unfinished.isEmpty():
        return None
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.max("shingles") / BLOCK_SHINGLES))
    chosen = unfinished.groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket"), blocks.alias("blocks"))
    placed = marked.join(chosen.select("bucket", "blocks"), "bucket").withColumn(
        "own_block", F.pmod(F.xxhash64("node"), F.col("blocks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rest = placed.where("rest").select("bucket", F.col("own_block").alias("i"), other.alias("j"), "node", "class", "rest")
    rest_blocks = rest.select("bucket", "i").distinct()
    every = (
        placed.select("bucket", F.col("own_block").alias("j"), "node", "class").join(rest_blocks, "bucket")
        .select("bucket", "i", "j", "node", "class", F.lit(False).alias("rest"))
    )
    together = rest.unionByName(every.select(*rest.columns)).groupBy("bucket", "i", "j", "node", "class").agg(F.max("rest").alias("rest"))
    found = saved(
        together.join(texts, "node").groupBy("bucket", "i", "j")
        .applyInArrow(_compare_block(shingle, similarity), "a binary, b binary").distinct()
    )
    return None if found.isEmpty() else found
