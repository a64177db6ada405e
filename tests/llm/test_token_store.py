import zlib

import numpy as np
import pyarrow as pa
import pytest

from shopledger.llm import text as T
from shopledger.llm import token_store as S

path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return S.encoder(path)


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def check(encoder, texts):
    for part in T.slices(pa.array(texts, pa.string())):
        ids, counts = encoder.encode(part)
        ends = np.cumsum(counts)
        for i in range(part.rows):
            assert ids[ends[i] - counts[i] : ends[i]].tolist() == plain(encoder, texts[part.first + i])


def test_pieces_as_the_library_cuts_them(encoder):
    check(encoder, [
        None, "", " ", "  ", "a", "it's", "it'll've 're", "'s's''s 's", "\n's \n\n  x", "x  ", " \t y", "'", "'re", "'r", "a'd b'm",
        "<|endoftext|>", "日本語 ² ½ Ⅷ 1٣", "😀😀 ‍", "a b  c", "᠎ x", "͸", "Ǆ ǅ", "é" * 50, "x" * 3000,
    ])


def test_words_that_a_polynomial_takes_for_one(encoder):
    from test_text import complements

    check(encoder, [" ".join(complements(11)), "x " + complements(11)[1], complements(10)[0]])


def test_random_texts(encoder):
    rng = np.random.default_rng(1)
    letters = np.array(list("ab'stredlvm  \n\t1 .,é日😀 ²"))
    check(encoder, ["".join(rng.choice(letters, rng.integers(0, 25))) for _ in range(4000)])


def test_perfect_hash():
    hashes = T.mixed(np.arange(20_000, dtype=np.uint64))
    perfect = S.PerfectHash.build(hashes)
    assert np.array_equal(np.sort(perfect.slots(hashes)), np.arange(len(hashes)))
    assert len(perfect.words) * 64 < 4.5 * len(hashes)
    other = perfect.slots(T.mixed(np.arange(30_000, 31_000, dtype=np.uint64)))
    assert other.max() < len(hashes)
    one = S.PerfectHash.build(np.zeros(1, np.uint64))
    assert one.slots(np.zeros(1, np.uint64)).tolist() == [0]
    twins = S.PerfectHash.build(np.array([5, 5, 9], np.uint64))  # can't be told apart: listed
    assert set(twins.slots(np.array([5, 9], np.uint64)).tolist()) <= {0, 1, 2}


def test_round_trip(spark, odd, odd_rows, encoder):
    store = S.write(odd, path, shard_ids=50)
    got = store.read(store.keys).collect()
    assert len(got) == len(odd_rows)
    got.sort(key=lambda r: r.start)
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    start = 0
    texts = {d: t for d, t, *_ in odd_rows}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == plain(encoder, texts[r.doc_id]) + [2] and r.n_tokens == len(ids) and r.start == start
        start += len(ids)
    assert sorted(r.number for r in got if r.doc_id == 6) == [1, 2]
    sums = {(r.doc_id, r.number): r.ids_crc32 for r in store.checksums(store.keys).collect()}
    assert sums == {(r.doc_id, r.number): zlib.crc32(r.ids) for r in got}


def test_several_shards(spark, encoder):
    texts = {i: f"number {i} " * 40_000 for i in range(9)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    store = S.write(df, path, shard_ids=200_000)
    assert store.shards.count() > 2
    start = 0
    for r in sorted(store.read(store.keys).collect(), key=lambda r: r.start):
        assert r.start == start and np.frombuffer(r.ids, "<u4").tolist() == plain(encoder, texts[r.doc_id]) + [2]
        start += r.n_tokens


def test_keyed_access_and_unknown_keys(spark, odd):
    store = S.write(odd, path)
    keys = spark.createDataFrame([(7, 1), (6, 2), (6, 3), (999, 1)], "doc_id long, number long")
    assert sorted((r.doc_id, r.number) for r in store.find(keys).collect()) == [(6, 2), (7, 1)]


def test_empty_table(odd):
    store = S.write(odd.limit(0), path)
    assert store.checksums(store.keys).collect() == []


ADDED = ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "a<|endoftext|", ">b", "<|endof", "text|> it's", "͸ <|endoftext|>", "plain"]


def fresh():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_added_tokens_as_in_the_library(encoder):
    encode, texts = fresh(), [*ADDED, None, "", *ADDED[::-1]]
    assert encode(ADDED[0]) == [87, 220, 50256, 331]
    part = next(T.slices(pa.array(texts, pa.string())))
    ids, counts = encoder.encode(part)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [encode(t) for t in texts]
    rng = np.random.default_rng(2)
    parts = np.array(["<|", "endoftext", "|>", "<|endoftext|>", " ", "\n", "'s", "日"])
    texts = ["".join(rng.choice(parts, rng.integers(0, 9))) for _ in range(500)]
    ids, counts = encoder.encode(next(T.slices(pa.array(texts, pa.string()))))
    assert ids.tolist() == [i for t in texts for i in encode(t)] and counts.tolist() == [len(encode(t)) for t in texts]


def test_store_and_stage_with_added_tokens(spark):
    import corpus_pipeline

    df = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    encode, start = fresh(), 0
    stored = S.write(df, path)
    staged = corpus_pipeline.STAGES[-1][1](spark, df, "").orderBy("start").collect()
    for text, r, s in zip(ADDED, sorted(stored.read(stored.keys).collect(), key=lambda r: r.start), staged, strict=True):
        ids = [*encode(text), 2]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and (r.start, s.start) == (start, start)
        assert (s.n_tokens, s.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
