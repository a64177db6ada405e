"""Line de-duplication over levelled sorted runs of line hashes, with DataFrame functions only.

A line's key is the line without space and \\t to \\r at both ends, A-Z lower-cased; keys are compared by two 64-bit hashes.
`Runs` holds one entry per key (in how many documents, the largest document id) in sorted, bucketed tables. A new batch of
documents is merged against them: keys that no run holds (anti-join) become a run of their own, what the batch adds to
known keys goes to a side list. When `fanout` runs of a level have come together they are merged into one of the next
level, so a key is rewritten once per level and a batch meets few runs.

Defined cases: a null text is one empty line, as an empty one is; a line repeated in one document counts once and its
copies share their fate; equal rows get equal results; rows that share a document id count as one document; a null document
id counts as the smallest one; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm.scratch import saved, shared_folder

BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class Runs:
    """An index of line keys that grows batch by batch.

    Runs lie below the shared folder; the catalog knows them, for their buckets, until `close`.
    """

    def __init__(self, spark: SparkSession, *, fanout: int = 2, buckets: int | None = None):
        if fanout < 2:
            raise ValueError("a merge takes two runs at least")
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.again: list[DataFrame] = []

    def _written(self, entries: DataFrame) -> str:
        name = f"llm_run_{uuid.uuid4().hex}"
        (
            entries.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
            .format("parquet").option("path", shared_folder(self.spark)).saveAsTable(name)
        )
        return name

    def _entries(self) -> DataFrame | None:
        tables = [self.spark.table(name) for level in self.levels for name in level]
        found = tables[0] if tables else None
        for more in tables[1:]:
            found = found.unionByName(more)
        return found

    def add(self, batch: DataFrame) -> None:
        """`batch`: one row per key with h1, h2, docs and last; its documents are in no other batch."""
        new = batch
        for level in self.levels:
            for name in level:
                run = self.spark.table(name).select(*KEY)
                new = new.join(run, KEY, "left_anti")
        name = self._written(new)
        if self.levels:
            self.again.append(saved(batch.join(self.spark.table(name).select(*KEY), KEY, "left_anti")))
        self._place(name, 0)

    def _place(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0])
            for other in full[1:]:
                merged = merged.unionByName(self.spark.table(other))
            self._place(self._written(merged), level + 1)
            for old in full:
                self.spark.sql(f"DROP TABLE {old}")

    def close(self) -> None:
        """Forget all runs; what was read from them must have been written before."""
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE {name}")
        self.levels = []

    def totals(self, least: int) -> DataFrame:
        """Keys found in at least `least` documents: h1, h2, docs, last."""
        entries = self._entries()
        for more in self.again:
            entries = entries.unionByName(more)
        summed = entries.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
        return summed.where(F.col("docs") >= least)


def dedup(documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", least_docs: int = 3,
          least_chars: int = 20, batches: int = 4, fanout: int = 2) -> DataFrame:
    """One row per document: doc_id, n_lines (before), n_dropped, kept (the remaining lines joined by newlines).

    Lines whose key has at least `least_chars` characters and is found in at least `least_docs` documents stay only in the
    document with the largest id among them. Texts are read twice, once for the keys of their lines, which move as hashes
    and positions, and once to write what is kept, when texts move to the positions of their lines.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
    )
    lines = texts.select("doc_id", "text_hash", F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    keyed = lines.select("doc_id", "text_hash", "at", line_key(F.col("line")).alias("key")).where(
        F.char_length("key") >= least_chars
    ).select(
        "doc_id", "text_hash", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"),
    )
    keyed = saved(keyed)
    runs = Runs(spark, fanout=fanout)
    for batch in range(batches):
        own = keyed.where(F.col("batch") == batch).select(*KEY, "doc_id").distinct()
        runs.add(own.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")))
    # written, so that the lines of a very common key can be split over tasks when they are joined
    often = saved(runs.totals(least_docs).select(*KEY, "last"))
    runs.close()
    dropped = keyed.join(often, KEY).where(
        F.coalesce(F.col("doc_id") < F.col("last"), F.col("last").isNotNull())
    ).groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("out"))
    joined = texts.join(
        dropped,
        texts["doc_id"].eqNullSafe(dropped["doc_id"]) & texts["text_hash"].eqNullSafe(dropped["text_hash"]),
        "left",
    ).select(texts["doc_id"], "text", "out")
    whole = F.coalesce("text", F.lit(""))
    return joined.select(
        "doc_id", (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("out"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("out").isNull(), whole).otherwise(_without(whole, F.col("out"))).alias("kept"),
    )


def _without(text: Column, out: Column) -> Column:
    """The lines of `text` but for those at the positions `out`, in time that grows with their number.

    Twice the position of every line, and twice plus one of those that go, are sorted together: a line goes if the number
    after its own is odd. One-element arrays keep Spark from splitting the text again for each line.
    """
    def kept(pair: Column) -> Column:
        lines, marks = pair["lines"], pair["marks"]
        stays = F.filter(
            marks, lambda x, i: (x % 2 == 0) & (F.coalesce(F.get(marks, i + 1), F.lit(0)) % 2 == 0)
        )
        return F.array_join(F.transform(stays, lambda x: F.get(lines, (x / 2).cast("int"))), "\n")

    def marked(lines: Column) -> Column:
        own = F.transform(lines, lambda _, i: i * 2)
        gone = F.transform(out, lambda x: x * 2 + 1)
        return F.struct(lines.alias("lines"), F.sort_array(F.concat(own, gone)).alias("marks"))

    return F.transform(F.transform(F.array(_lines(text)), marked), kept)[0]
