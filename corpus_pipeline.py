"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

A document is told from others by its id together with a hash of its text, so rows that share an id but differ in text are
decided one by one, and null ids take part like others. Empty tables pass through. All stages but the last return the
columns of documents, whatever these are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopledger.llm import mixing, order_minhash, subword_classifier, token_store, winnowing
from shopledger.llm.inputs import GOOD, quality_model, table, tokenizer_file
from shopledger.llm.scratch import saved, send_code



def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of `docs` has them."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    return docs.withColumn(key, F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash")))


def _same(docs: DataFrame, key: str, other: DataFrame, *ids: str):
    own, own_hash = ids
    return docs["doc_id"].eqNullSafe(other[own]) & docs[key]["text_hash"].eqNullSafe(other[own_hash])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier accepts."""
    send_code(spark)
    model = quality_model(spark, docs, sf_dir)
    [score] = fresh(docs, "_quality")
    return subword_classifier.score(docs, model, score_column=score).where(F.col(score) >= GOOD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the smallest id."""
    send_code(spark)
    key, nth, own, own_hash = fresh(docs, "_document_key", "_nth", "_id", "_hash")
    kept = order_minhash.classes(docs).where("kept").select(F.col("doc_id").alias(own), F.col("text_hash").alias(own_hash))
    keyed = _keyed(docs, key)
    equal_rows = Window.partitionBy("doc_id", f"{key}.text_hash").orderBy(F.lit(0))
    return (
        keyed.join(kept.distinct(), _same(keyed, key, kept, own, own_hash), "left_semi")
        .withColumn(nth, F.row_number().over(equal_rows)).where(F.col(nth) == 1).drop(nth, key)
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    send_code(spark)
    key, own, own_hash = fresh(docs, "_document_key", "_id", "_hash")
    keyed = _keyed(docs, key)
    hit = winnowing.scan(keyed, table(spark, sf_dir, "benchmark"), id_column=key).where("n_hit > 0").select(
        F.col("doc_id.doc_id").alias(own), F.col("doc_id.text_hash").alias(own_hash)
    )
    return keyed.join(hit, _same(keyed, key, hit, own, own_hash), "left_anti").drop(key)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    key, own, own_hash, own_source, copies, copy = fresh(
        docs, "_document_key", "_id", "_hash", "_source", "_copies", "_copy")
    keyed = _keyed(docs, key)
    taken = mixing.mix(keyed, id_column=key).where("copies > 0").select(
        F.col("doc_id.doc_id").alias(own), F.col("doc_id.text_hash").alias(own_hash),
        F.col("source").alias(own_source), F.col("copies").alias(copies),
    ).distinct()
    held = keyed.join(
        taken, _same(keyed, key, taken, own, own_hash) & keyed["source"].eqNullSafe(taken[own_source]))
    return held.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies).cast("long")))).select(
        *(keyed[c] for c in docs.columns)
    )


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token store gives back for each document: doc_id, number (of its copy), start, n_tokens, ids_crc32."""
    send_code(spark)
    store = token_store.write(docs, tokenizer_file())
    return store.checksums(store.keys)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

ORACLE_SQL = None  # learned scores, hashes and chance can't be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
