import hashlib
import re

import pytest

from brute import sha
from shopledger.llm import frames
from shopledger.llm.fill_in_middle import digests, output, restored, store, texts, transform
from shopledger.llm.frames import framed

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc, text, percent=50):
    """n, form, prefix and middle length, output."""
    text, h = text or "", hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(spark, rows):
    more = [(1000 + i, f" {i} <M" + "ä \U0001f600\t" * (i % 7) + "x  >\n" * (i % 5)) for i in range(60)]
    more += [(2000, "a <P> b"), (2001, "<M>"), (2002, "<<S >P> ok"), (2003, "\x00 \x0b\x0c nul"), (2004, "   wide")]
    return [(r[0], r[1]) for r in rows] + more


@pytest.mark.parametrize("percent", [50, 100])
def test_against_plain_cuts(spark, odd_rows, percent):
    rows = rows_of(spark, odd_rows)
    df = spark.createDataFrame([(*r, "f", 1, b"x", "n") for r in rows],
                               "doc_id long, text string, form string, n int, frames binary, units string").repartition(3)
    made = transform(store(df), percent=percent)
    expected = sorted(((doc, *plainly(doc, text, percent), text or "") for doc, text in rows), key=str)
    whole = texts(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    assert sorted((tuple(r) for r in whole), key=str) == [x[:-1] for x in expected]
    found = digests(made).select("doc_id", "form", "output_sha256", "restored_sha256").collect()
    assert sorted(map(tuple, found), key=str) == sorted(((x[0], x[2], sha(x[5]), sha(x[6])) for x in expected), key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert digests(transform(store(empty))).collect() == []


@pytest.mark.parametrize("limit", [1, 5, 64, 1000])
def test_frames_hold_whole_units_and_find_every_place(limit):
    text = "  one twoé\n\n日本語 \U0001f600x " + "long" * 40 + " end" * 30 + " \t "
    for text in (text, text.strip(), "", " ", "x" * 500, " " * 500, "x" * 300 + " " + "y" * 300):
        data, units = text.encode(), UNIT.findall(text)
        for size in (1, 7, len(data) + 1):
            held = framed((data[i : i + size] for i in range(0, len(data), size)), limit)
            assert b"".join(held.stream()) == data and held.n == len(units)
            assert "".join(u for u in units) == text and held.end.chars == len(text)
        for n in range(len(units) + 1):
            before, place = "".join(units[:n]), held.place(n)
            assert place.chars == len(before)
            assert b"".join(held.stream(None, place)) == before.encode()
            assert b"".join(held.stream(place)) == data[len(before.encode()):]


def test_only_the_frames_of_the_cuts_are_opened(monkeypatch):
    held = framed([b"some words here " * 4000], 1000)
    opened, plain = [], frames.Frames.opened
    monkeypatch.setattr(frames.Frames, "opened", lambda self, i: opened.append(i) or plain(self, i))
    held.place(6000)
    assert len(held.frames) > 50 and len(opened) == 1


def test_restoring_needs_output_and_form_only():
    text = "<P <S is no mark< M> here <" + " S> <" * 50
    held = framed([text.encode()], 8)
    for form in ("psm", "spm"):
        for a in range(held.n + 1):
            made = framed(output(held, form, held.place(a), held.place((a + held.n) // 2)), 8)
            assert b"".join(restored(made, form)).decode() == text


def test_marks_that_cannot_be_found_again(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for marks in (("<P>", "<P>", "<M>"), ("< P>", "<S>", "<M>"), ("<P>", "<P>x", "<M>"), ("ab", "ba", "c"), ("", "a", "b")):
        with pytest.raises(ValueError):
            store(df, marks=marks)
