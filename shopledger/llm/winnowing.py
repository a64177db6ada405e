"""Benchmark decontamination by winnowing.

Words are hashed; every `window` consecutive words keep their smallest `gram`-word hash as a fingerprint (the rightmost
of equal ones). A span of at least `window` shared words holds one such window in both texts, so both keep the same
fingerprint: no shared span of that length is missed. Fingerprint matches are extended to the whole window, and the words
inside are hit. An item with fewer words is one window of its own length and is looked up at every position.

Defined cases: null and wordless texts have no words and no hits; equal rows each get their result; a repeated item_id
counts once; empty tables give empty or clean results; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm import text as T
from shopledger.llm.scratch import saved

FILTER_BITS = 1 << 23  # size of the two filters sent to the tasks, whatever the size of the benchmark

_HIT = pa.struct([("start", pa.int64()), ("length", pa.int32()), ("fingerprint", pa.int64()), ("whole", pa.int64())])


def _starts(first_word: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and start of each span of `length` words inside one text."""
    counts = np.maximum(np.diff(first_word) - length + 1, 0)
    return np.repeat(np.arange(len(counts)), counts), T.flat(counts, first_word[:-1])


def _window_prints(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For each start, the smallest gram hash among the `window` words from there on."""
    g = T.grams(hashes, gram)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    least = g[:n].copy()
    for i in range(1, window - gram + 1):
        np.minimum(least, g[i : i + n], out=least)
    return least


def _item_windows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(1)):
                hashes, _, first = T.words(part)
                counts = np.diff(first)
                for length in sorted({min(int(c), window) for c in counts if c}):
                    row, start = _starts(first, length)
                    keep = (counts[row] == length) | (length == window)
                    row, start = row[keep], start[keep]
                    whole = T.grams(hashes, length)[start]
                    prints = _window_prints(hashes, window, gram)[start] if length == window else whole
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(row + part.first)),
                            pa.array(np.full(len(row), length), pa.int32()),
                            pa.array(prints.view(np.int64)),
                            pa.array(whole.view(np.int64)),
                        ],
                        ["item_id", "length", "fingerprint", "whole"],
                    )

    return run


def _bits(windows: DataFrame, column: str) -> np.ndarray:
    """A filter of fixed size over a hash column: at most FILTER_BITS / 32768 rows of 4 kB reach the driver."""
    at = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1  # the bitmap functions count from 1
    rows = (
        windows.groupBy(F.bitmap_bucket_number(at).alias("n"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        .collect()
    )
    out = np.zeros((FILTER_BITS // 32768 + 1, 4096), np.uint8)
    for row in rows:
        out[row.n] = np.frombuffer(row.bits, np.uint8)
    return np.unpackbits(out[1:].reshape(-1), bitorder="little").view(bool)[:FILTER_BITS]


def _document_windows(window: int, gram: int, lengths, filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints_seen, whole_seen = filters.value
        mask = np.uint64(FILTER_BITS - 1)
        for batch in batches:
            for part in T.slices(batch.column(1)):
                hashes, _, first = T.words(part)
                rows, fields = [], []
                for length in lengths:
                    row, start = _starts(first, length)
                    whole = T.grams(hashes, length)
                    prints = _window_prints(hashes, window, gram) if length == window else whole
                    maybe = prints_seen[prints & mask]
                    maybe &= whole_seen[whole & mask]
                    keep = maybe[start]
                    row, start = row[keep], start[keep]
                    rows.append(row)
                    fields.append((start - first[row], np.full(len(row), length), prints[start].view(np.int64), whole[start].view(np.int64)))
                row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
                order = np.argsort(row, kind="stable")
                columns = [np.concatenate(x)[order] for x in zip(*fields)] if fields else [row] * 4
                hits = pa.StructArray.from_arrays(
                    [pa.array(c).cast(f.type) for c, f in zip(columns, _HIT)], fields=list(_HIT)
                )
                ends = np.searchsorted(row[order], np.arange(part.rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.rows),
                        pa.array(np.diff(first), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits),
                    ],
                    ["doc_id", "n_words", "maybe"],
                )

    return run


def scan(documents: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
         item_column: str = "item_id", item_text: str = "text", window: int = 10, gram: int = 5) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted list of item ids as strings).

    Windows of items and documents meet in joins on hashes, first on the fingerprint and then on the whole window. Two
    filters of fixed size, built from all items, keep most windows of the documents from being sent; a benchmark too
    large for them only makes them less selective.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram must fit into the window")
    spark = documents.sparkSession
    items = benchmark.select(F.col(item_column).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    windows = saved(
        items.mapInArrow(_item_windows(window, gram), "item_id string, length int, fingerprint long, whole long").distinct()
    )
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())  # at most `window` numbers
    filters = spark.sparkContext.broadcast((_bits(windows, "fingerprint"), _bits(windows, "whole")))
    ids = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = ids.schema["doc_id"].dataType.simpleString()
    scanned = saved(
        ids.mapInArrow(
            _document_windows(window, gram, lengths, filters),
            f"doc_id {id_type}, n_words long, maybe array<struct<start long, length int, fingerprint long, whole long>>",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    maybe = scanned.where(F.size("maybe") > 0).select("row", F.inline("maybe"))
    prints = windows.select("length", "fingerprint").distinct()
    fitting = maybe.join(prints, ["length", "fingerprint"], "left_semi").drop("fingerprint")
    whole = windows.select("length", "whole", "item_id").distinct()
    hits = fitting.join(whole.select("length", "whole").distinct(), ["length", "whole"], "left_semi")
    covered = _covered(hits.select("row", "start", "length").distinct())
    found = (
        hits.select("row", "length", "whole").distinct().join(whole, ["length", "whole"])
        .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    return (
        scanned.select("row", "doc_id", "n_words")
        .join(covered, "row", "left").join(found, "row", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _covered(spans: DataFrame) -> DataFrame:
    """Words of a document inside at least one of its spans; a group is no longer than the document."""
    spans = spans.groupBy("row", "start").agg(F.max("length").alias("length"))
    in_order = F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("stop"))))
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("stop"))
    summed = F.aggregate(
        "spans", state,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], s["stop"]))).alias("n"),
            F.greatest(s["stop"], x["stop"]).alias("stop"),
        ),
    )
    return spans.groupBy("row").agg(in_order.alias("spans")).select("row", summed["n"].alias("n_hit"))
