import numpy as np
import pyarrow as pa
from brute import words
from hypothesis import given, settings
from hypothesis import strategies as st

from shopledger.llm import text as T

TEXTS = st.lists(st.none() | st.text(alphabet=st.sampled_from("aBz09 é日\n.-_😀\x7f{`@"), max_size=30), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, limit):
    known = {}
    for part in T.slices(pa.array(texts, pa.string()), limit):
        hashes, _, first = T.words(part)
        for i in range(part.rows):
            expected = words(texts[part.first + i])
            got = hashes[first[i] : first[i + 1]].tolist()
            assert len(got) == len(expected)
            for word, value in zip(expected, got):
                assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_text_longer_than_a_piece():
    text = "alpha beta " * 500_000
    (part,) = T.slices(pa.array([text]))
    hashes, places, first = T.words(part)
    assert first.tolist() == [0, 1_000_000] and len(np.unique(hashes)) == 2
    assert places[:3].tolist() == [0, 6, 11]


def test_sliced_arrays_and_grams():
    column = pa.array(["x", "a b c d", None, "b c d"]).slice(1)
    (part,) = T.slices(column)
    hashes, _, first = T.words(part)
    grams = T.grams(hashes, 3)
    assert first.tolist() == [0, 4, 4, 7] and grams[1] == grams[4] != grams[0]
    assert T.flat(np.array([2, 0, 3]), np.array([5, 9, 1])).tolist() == [5, 6, 1, 2, 3]


def complements(doublings):
    """Two words of a and b, each the other's complement, that no polynomial modulo a power of two tells apart."""
    one = "a"
    for _ in range(doublings):
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_regular_words_have_hashes_of_their_own():
    for doublings in range(1, 14):
        (part,) = T.slices(pa.array([" ".join(complements(doublings))]))
        one, other = T.words(part)[0]
        assert one != other


def test_spans_hash_alike_wherever_they_lie(monkeypatch):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 5, 3000).astype(np.uint8)
    cuts = np.sort(rng.integers(0, 3001, 400))
    starts, ends = cuts[:-1], cuts[1:]
    whole = T.span_hashes(values, starts, ends)
    monkeypatch.setattr(T, "_BLOCK", 7)
    assert (T.span_hashes(values, starts, ends) == whole).all()
    known = {}
    for a, b, h in zip(starts, ends, whole.tolist()):
        assert known.setdefault(values[a:b].tobytes(), h) == h
        assert T.span_hashes(values[a:b], np.array([0]), np.array([b - a]))[0] == h
    assert len(set(known.values())) == len(known)
