import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from shopledger.llm.scratch import saved

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, odd):
    root = tmp_path_factory.mktemp("tables")
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(500)]
    good = [" ".join(rng.choice(vocabulary, 60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good)] + [(100 + i, good[i] + " end") for i in range(5)] + [(200, good[0])] * 2
    rows += [(300 + i, t.upper().replace(" ", "!! ")) for i, t in enumerate(good[:20])]
    rows += [(400, " ".join(rng.choice(vocabulary, 40)) + " leaked words of a test item that nobody may ever see again")]
    documents = spark.createDataFrame(
        [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t), 1, "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, n int, _id string",
    )
    documents.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300), 0) for i, _ in rows], "doc_id long, quality int, toxic int").distinct() \
        .write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, "leaked words of a test item that nobody may ever see again")], "item_id long, text string") \
        .write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages(spark, folder):
    docs = P.table(spark, folder, "documents")
    columns = docs.columns
    ids = {}
    for name, stage in P.STAGES[:-1]:
        docs = saved(stage(spark, docs, folder))
        assert docs.columns == columns
        ids[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert ids["quality"] == [*range(60), *range(100, 105), 200, 200, 400]
    assert ids["near_duplicates"] == [*range(60), 400]
    assert ids["decontamination"] == [*range(60)]
    assert set(ids["mixture"]) <= set(range(60)) and 80 <= len(ids["mixture"]) <= 100
    out = P.STAGES[-1][1](spark, docs, folder).orderBy("start").collect()
    assert [r.doc_id for r in out] == ids["mixture"]
    encode = P.token_store.encoder(P.tokenizer_file()).tokenizer.encode
    texts = {r.doc_id: r.text for r in docs.collect()}
    start = 0
    for r in out:
        tokens = np.array([*encode(texts[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(tokens), zlib.crc32(tokens.tobytes()))
        start += len(tokens)


def test_run_agrees_with_itself(spark, folder):
    first, again = (sorted(map(tuple, P.run(spark, folder).collect())) for _ in range(2))
    assert first == again and first


def test_odd_rows_pass_through_every_stage(spark, odd, folder):
    docs = odd.withColumnRenamed("score", "_quality_note")
    for _, stage in P.STAGES[:-1]:
        out = saved(stage(spark, docs, folder))
        assert out.columns == docs.columns
        assert saved(stage(spark, docs.limit(0), folder)).count() == 0
    assert P.STAGES[-1][1](spark, docs, folder).count() == docs.count()
    assert P.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0


def test_columns_named_like_the_stages_own(spark, folder):
    from pyspark.sql import functions as F

    names = ["_quality", "_nth", "_document_key", "_id_", "_hash", "_source", "_copies", "_copy", "copies", "node"]
    docs = P.table(spark, folder, "documents").where("doc_id < 30").withColumns({c: F.lit(f"own {c}") for c in names})
    for _, stage in P.STAGES[:-1]:
        out = saved(stage(spark, docs, folder))
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select(*names).collect()} == {tuple(f"own {c}" for c in names)}
