"""The registered queries of this subpackage and the SQL that says what they mean."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shopledger.llm import (
    curve_search, fill_in_middle, language_id, license_scan, line_dedup, mixing, order_minhash, pivot_search, product_codes,
    statements, subword_classifier, token_store, url_aliases, winnowing,
)
from shopledger.llm.inputs import GOOD, held_out, quality_model, table, tokenizer_file
from shopledger.llm.scratch import saved, send_code


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents.select("doc_id", "text", "lang").where(~held_out()))
    found = language_id.identify(documents, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_store.write(table(spark, sf_dir, "documents"), tokenizer_file())
    return store.checksums(store.keys).select("doc_id", "start", "n_tokens", "ids_crc32")


URL_RULES = [
    url_aliases.Rule("org", "/", "allow"),
    url_aliases.Rule("example.org", "/es/", "block"),
    url_aliases.Rule("example.org", "/en/1", "block"),
    url_aliases.Rule("com", "/fr/", "allow"),
    url_aliases.Rule("com", "/de/", "block"),
]


def op5_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_aliases.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20, scale=64)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(spark, documents, sf_dir)
    scored = subword_classifier.score(documents, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), inside=True)


def op11_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = product_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.rows.select("vec_id", "code", "error", "label_error", F.lit(found.sha256).alias("codebooks_sha256"))


def op12_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_search.search(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = saved(fill_in_middle.store(table(spark, sf_dir, "documents")))
    return fill_in_middle.digests(fill_in_middle.transform(stored))


def _with_code(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        send_code(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _with_code(query) for query in (
        op1_language, op2_line_dedup, op3_near_duplicates, op4_token_store, op5_url_aliases, op6_pivot_search, op7_quality,
        op8_decontamination, op9_mixing, op10_license_scan, op11_product_codes, op12_curve_search, op13_fill_in_middle,
    )
} | {"pipeline": _with_code(corpus_pipeline.run)}

SQL: dict[str, str] = {
    "op2_line_dedup": statements.LINE_DEDUP,
    "op5_url_aliases": statements.url_aliases(URL_RULES),
    "op6_pivot_search": statements.PIVOT_SEARCH,
    "op8_decontamination": statements.DECONTAMINATION,
    "op11_product_codes": statements.product_codes(),
    "op13_fill_in_middle": statements.FILL_IN_MIDDLE,
}
