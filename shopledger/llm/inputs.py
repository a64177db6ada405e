"""Tables and settings that the queries and the pipeline share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import subword_classifier

FOLDS = 5
GOOD = 0.3  # least score of a document that counts as good


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def quality_model(spark: SparkSession, documents: DataFrame, sf_dir: str) -> subword_classifier.Model:
    """Learned from labelled rows that aren't held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return subword_classifier.fit(documents.select("doc_id", "text"), labels.where(~held_out()))


def tokenizer_file() -> str:
    """The tokenizer's vocabulary, at the same path on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
