"""Product quantisation of vectors, with Orchard's search for the nearest codebook entry.

Each vector is cut into equal parts, and each part position has a codebook of a few entries, found by rounds of k-means on whole
numbers. Orchard's search keeps, for every entry of a codebook, the list of the other entries by their distance from it. A
part starts at entry 0 and walks along that entry's list; an entry that is nearer, or as near with a lower index, is
jumped to and its list is walked from its begin. Entries seen once are marked and skipped. The walk ends at an entry
farther than twice the current distance: it and all behind it are farther from the part than the current entry, by the
triangle inequality, in whole numbers 4 times the squared distance. So the search is exact.

Vectors stay where they are: a round sends 8 x 16 codebook entries out and gets sums and counts by entry and component back.

Components are floor(scale * x), kept within 2**52 either way; the error of a row, and that of a label, is kept within 64
bits. Defined cases: vectors that are null or hold null or non-finite components are dropped; shorter vectors count as
filled up with zeros, to the next width that the parts divide; with fewer rows than entries, the codebooks are smaller;
rows with null ids are coded too and follow all others as first entries, rows that share an id are ordered by their
vectors; null labels are one label; equal rows each get their result; an empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.scratch import saved
from shopledger.llm.vectors import matrix, usable

LIMIT = 2.0**52  # of a component; beyond it doubles skip whole numbers
PLAIN = 1 << 20  # components up to here are squared and summed in 64 bits
HOT_SHARE = 10_000
_HALF = 31


@dataclass
class Codebooks:
    """`entries` by part, entry and component; `order` and `far` are the neighbour lists by part and entry."""

    entries: np.ndarray
    order: np.ndarray
    far: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebooks:
        squares = ((entries[:, :, None] - entries[:, None, :]) ** 2).sum(axis=3)
        parts, k = squares.shape[:2]
        order, far = np.zeros((parts, k, max(k - 1, 0)), np.int64), np.zeros((parts, k, max(k - 1, 0)), squares.dtype)
        for p in range(parts):
            for e in range(k):
                near = sorted((x for x in range(k) if x != e), key=lambda x: (squares[p, e, x], x))
                order[p, e], far[p, e] = near, squares[p, e, near]
        return cls(entries, order, far)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Entry and squared distance for each part of each row, and how many distances were looked at.

        All parts of all rows walk side by side, each along its own list.
        """
        n, (parts, k, width) = len(rows), self.entries.shape
        lanes, part = rows.reshape(n * parts, width), np.tile(np.arange(parts), n)
        current = np.zeros(n * parts, np.int64)
        best = ((lanes - self.entries[part, 0]) ** 2).sum(axis=1)
        at, seen, looked = np.zeros(n * parts, np.int64), np.ones(n * parts, np.int64), n * parts
        walking = np.arange(n * parts) if k > 1 else np.zeros(0, np.int64)
        while len(walking):
            p, c, i = part[walking], current[walking], at[walking]
            on = (self.far[p, c, i] <= 4 * best[walking]).astype(bool)
            walking, p, c, i = walking[on], p[on], c[on], i[on]
            entry = self.order[p, c, i]
            at[walking] += 1
            new = (seen[walking] >> entry & 1) == 0
            lane, entry = walking[new], entry[new]
            seen[lane] |= 1 << entry
            distance = ((lanes[lane] - self.entries[part[lane], entry]) ** 2).sum(axis=1)
            looked += len(lane)
            better = ((distance < best[lane]) | ((distance == best[lane]) & (entry < current[lane]))).astype(bool)
            lane = lane[better]
            best[lane], current[lane], at[lane] = distance[better], entry[better], 0
            walking = walking[at[walking] < k - 1]
        return current.reshape(n, parts), best.reshape(n, parts), looked


@dataclass
class Codes:
    """`rows` has vec_id, label, code, error and label_error; the codebooks have a fixed size."""

    rows: DataFrame
    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
             parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096) -> Codes:
    """Two hex digits of code by part for each vector, its squared error, and the error summed over its label."""
    if not 0 < entries <= 63:
        raise ValueError("from 1 to 63 entries")
    whole = F.transform(F.col(vector_column), lambda x: F.greatest(
        F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * float(scale)).cast("double"))).cast("long"))
    kept = saved(vectors.where(usable(vector_column)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"), whole.alias("v")))
    size = kept.agg(F.max(F.size("v")).alias("width"),
                    F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))).alias("most")).first()
    part_width = -(-(size.width or 0) // parts)
    width = part_width * parts
    kind = np.int64 if (size.most or 0) <= PLAIN else object  # Python's own whole numbers where 64 bits can't hold a square
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), width), kind)
    for i, row in enumerate(first):
        start[i, : len(row.v)] = row.v
    book = start.reshape(len(first), parts, part_width).transpose(1, 0, 2)
    for _ in range(rounds if len(first) and width else 0):
        book = _moved(kept.select("v"), book)

    found, books = len(first), Codebooks.of(book) if len(first) else None

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch) or not found:
                continue
            entry, squares, _ = books.nearest(matrix(batch.column(2), width, kind))
            error = np.minimum(squares.sum(axis=1), (1 << 63) - 1).astype(np.int64)
            digits = np.array([f"{e:02x}" for e in range(found)])[entry]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(["".join(row) for row in digits], pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    schema = kept.select("vec_id", "label").schema.add("code", "string").add("error", "long")
    return Codes(_with_label_error(saved(kept.mapInArrow(code, schema))), book)


def _moved(kept: DataFrame, book: np.ndarray) -> np.ndarray:
    """The entries after one round: each becomes the mean of the parts nearest to it, rounded down."""
    books, (parts, found, part_width), kind = Codebooks.of(book), book.shape, book.dtype

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts * found, part_width), object), np.zeros(parts * found, np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), parts * part_width, kind)
            entry, _, _ = books.nearest(rows)
            slot = (entry + np.arange(parts) * found).ravel()
            lanes, order = rows.reshape(-1, part_width), np.argsort(slot, kind="stable")
            used, begins = np.unique(slot[order], return_index=True)
            if len(used):
                total[used] += np.add.reduceat(lanes[order], begins, axis=0)
                count += np.bincount(slot, minlength=parts * found)
        slot, j = np.divmod(np.flatnonzero(np.repeat(count > 0, part_width)), part_width)
        number = total[slot, j]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int64()), pa.array(j, pa.int64()), pa.array(count[slot], pa.int64()),
             pa.array([int(x) >> _HALF for x in number], pa.int64()),
             pa.array([int(x) & ((1 << _HALF) - 1) for x in number], pa.int64())],
            ["slot", "j", "n", "high", "low"],
        )

    # two halves of each sum, so that none leaves 64 bits
    added = kept.mapInArrow(sums, "slot long, j long, n long, high long, low long").groupBy("slot", "j").agg(
        *(F.sum(c).alias(c) for c in ("n", "high", "low"))
    ).collect()
    out = book.copy()
    for row in added:  # parts x entries x components at most
        out[row.slot // found, row.slot % found, row.j] = ((row.high << _HALF) + row.low) // row.n
    return out


def _with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` with the error summed by label.

    Labels that hold at least one of `HOT_SHARE` rows, of which there can't be more than `HOT_SHARE`, are sent to all
    tasks; rows of the other labels are joined by label.
    """
    wide = F.sum(F.col("error").cast("decimal(19,0)"))
    sums = saved(coded.groupBy("label").agg(
        F.least(wide, F.lit((1 << 63) - 1).cast("decimal(29,0)")).cast("long").alias("label_error"), F.count("*").alias("n")))
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_SHARE >= total
    by_label, left = sums.select(F.col("label").alias("same"), "label_error", "n"), []
    often = coded.join(F.broadcast(by_label.where(hot)), F.col("label").eqNullSafe(F.col("same")), "left")
    if not sums.where(~hot).isEmpty():
        rare = often.where("n IS NULL").drop("same", "label_error", "n")
        left.append(rare.join(by_label.where(~hot), F.col("label").eqNullSafe(F.col("same"))))
        often = often.where("n IS NOT NULL")
    for df in left:
        often = often.unionByName(df)
    return often.drop("same", "n")
