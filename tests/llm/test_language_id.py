import os
import zlib

import pytest

from shopledger.llm import language_id as L
from shopledger.llm import text as T

DATA = "/root/testdata/sf0.01"


def phrases(symbols, sample):
    """Greedy longest matches, within stretches."""
    n = 0
    for at in range(0, len(symbols), L.STRETCH):
        piece = symbols[at : at + L.STRETCH]
        while piece:
            size = 1
            while size < len(piece) and piece[: size + 1] in sample:
                size += 1
            piece, n = piece[size:], n + 1
    return n


def test_phrases_are_longest_matches():
    import pyarrow as pa

    samples = {"a": ["the theme of the thesis is there"], "b": ["le theme de la these est la"]}
    model = L.train(samples)
    texts = ["The thesis?! is LA the", "xyz etheme", "", "h", "the " * 400, None, "日本 the"]
    for part in T.slices(pa.array(texts)):
        symbols, bounds, _ = model.symbols(part)
        counts = model.phrases(symbols, bounds)
        for i, language in enumerate(model.languages):
            sample, _, _ = model.symbols(next(T.slices(pa.array(samples[language]))))
            for row in range(part.rows):
                own = symbols[bounds[row] : bounds[row + 1]].tobytes()
                assert counts[i, row] == phrases(own, sample.tobytes())


def test_odd_rows(spark, odd, odd_rows):
    model = L.fit(odd.select("doc_id", "text", "lang"))
    assert model.languages == ["de", "en"]  # the only French text has no letter
    rows = L.identify(odd, model).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows}
    for doc in (1, 2, 3, 4):
        assert (by_id[doc].lang_pred, by_id[doc].score) == ("und", 0.0)
    assert by_id[7].lang_pred == "en" and by_id[12].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in rows)
    assert L.identify(odd.limit(0), model).collect() == []


def test_nothing_learned(odd):
    rows = L.identify(odd, L.fit(odd.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_held_out_accuracy(spark):
    from shopledger.llm.entry import QUERIES

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op1_language"](spark, DATA).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held)
