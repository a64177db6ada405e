import os

import numpy as np
import pyarrow as pa
import pytest

from shopledger.llm import subword_classifier as C
from shopledger.llm import text as T

DATA = "/root/testdata/sf0.01"


def test_features_stay_inside_texts():
    texts = ["ab cd", "", None, "cd cd cd", "x"]
    (part,) = T.slices(pa.array(texts))
    together = [[], [], [], [], []]
    for bucket, before in C.features(part.data, part.bounds, 1 << 16):
        for i in range(5):
            together[i] += sorted(bucket[before[i] : before[i + 1]].tolist())
    for i, text in enumerate(texts):
        alone = []
        if text:
            data = np.frombuffer(text.encode(), np.uint8)
            for bucket, _ in C.features(data, np.array([0, len(data)]), 1 << 16):
                alone += sorted(bucket.tolist())
        assert together[i] == alone
    assert len(together[0]) == 2 + 3 + 2 + 1 and len(together[3]) == 3 + 2 + 6 + 5 + 4


def test_learns_and_scores_whole_texts(spark):
    rows = [(i, ("good clean prose " if i % 2 else "BUY!! NOW!! ") * (3 + i % 5), i % 2) for i in range(80)]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:60]] + [(1, None), (2, 7)], "doc_id long, label int")
    model = C.fit(docs, labels, buckets=1 << 12)
    scored = C.score(docs, model).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in scored)
    long_tail = spark.createDataFrame([(0, "good clean prose " * 50 + "BUY!! NOW!! " * 20_000)], "doc_id long, text string")
    assert C.score(long_tail, model).first().score < 0.5


def test_odd_rows(odd, odd_rows):
    labels = odd.selectExpr("doc_id", "cast(doc_id % 2 as int) as label")
    model = C.fit(odd, labels, buckets=1 << 10, epochs=1)
    rows = C.score(odd, model).collect()
    assert len(rows) == len(odd_rows) and rows[0].asDict().keys() == odd.drop("score").toPandas().assign(score=0).to_dict("list").keys()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert C.score(odd.limit(0), model).collect() == []


@pytest.mark.parametrize("labels, expected", [([], 0.5), ([1], 1.0), ([0], 0.0)])
def test_too_few_labels(labels, expected):
    model = C.train(["some text"] * len(labels), labels)
    assert model.score(next(T.slices(pa.array(["some text"]))))[0] == pytest.approx(expected)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_held_out_accuracy(spark):
    from shopledger.llm.entry import QUERIES

    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = QUERIES["op7_quality"](spark, DATA).collect()
    assert len(rows) == 1000 and all(r.predicted == (r.score >= 0.3) for r in rows)
    held = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert sum(held) >= 0.95 * len(held)
