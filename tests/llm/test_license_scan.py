from collections import Counter

import numpy as np
import pytest
from brute import BLANK, words

from shopledger.llm.entry import QUERIES
from shopledger.llm.license_scan import TEMPLATES, THRESHOLD, Templates, scan


def brute(text, templates, threshold):
    text, best = text or "", {}
    lines = text.split("\n")
    units, paragraph = list(lines), []
    for line in [*lines, ""]:
        if line.strip(BLANK):
            paragraph.append(line)
        elif paragraph:
            units.append("\n".join(paragraph))
            paragraph = []
    pairs = lambda t: Counter(zip(words(t), words(t)[1:]))
    for unit in [*units, text]:
        own = pairs(unit)
        for name, texts in templates.items():
            for template in texts:
                other = pairs(template)
                score = 2 * (own & other).total() / max(1, own.total() + other.total())
                if score >= threshold:
                    best[name] = max(best.get(name, 0), score)
    return best


def test_against_brute_force(spark, odd_rows):
    mit = TEMPLATES["MIT"][1]
    texts = [t for _, t, *_ in odd_rows[:10]] + [
        "\n\n".join(TEMPLATES["MIT"]), mit.replace(". ", ".\n\n"), "a b\n" + TEMPLATES["ISC"][1].replace(", ", ",\n") + "\n \nfoo",
        mit.upper(), mit[: len(mit) // 2], "released under THE mit license", mit + " " + mit, "x\nLicensed under CC BY-NC 4.0.\n",
        mit.replace("Software", "Program"), "\n".join(t for ts in TEMPLATES.values() for t in ts),
    ]
    for threshold in (0.3, THRESHOLD, 1.0):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {}
        for r in scan(df, threshold=threshold).collect():
            got.setdefault(r.doc_id, {})[r.license] = r.score
            assert r.passage in texts[r.doc_id]
        expected = {i: b for i, t in enumerate(texts) if (b := brute(t, TEMPLATES, threshold))}
        assert got.keys() == expected.keys()
        for i, best in expected.items():
            assert got[i] == pytest.approx(best)


def test_odd_rows_and_size_bounds(odd):
    assert scan(odd.limit(0)).collect() == []
    rows = scan(odd, {"same": ["the same line in many documents", "x"]}).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id) == [7, 8, 9, 10, 11] and sum(r.doc_id is None for r in rows) == 1
    bounds = Templates({"t": ["a b c d e f g h i j k"]}, 0.8)
    assert (bounds.low.tolist(), bounds.high.tolist()) == ([7.0], [15.0])
    with pytest.raises(ValueError):
        Templates({}, 0)


def brute_inside(text, templates, threshold):
    own, best = words(text), {}
    pairs = list(zip(own, own[1:]))
    for name, texts in templates.items():
        for template in texts:
            other = words(template)
            other = Counter(zip(other, other[1:]))
            for i in range(len(pairs)):
                for j in range(i + 1, len(pairs) + 1):
                    score = 2 * (Counter(pairs[i:j]) & other).total() / (j - i + other.total())
                    if score >= threshold:
                        best[name] = max(best.get(name, 0), score)
    return best


def test_runs_of_words_against_brute_force(spark):
    rng = np.random.default_rng(3)
    text = lambda letters, n: "".join(w + s for w, s in zip(
        rng.choice(list(letters), n), rng.choice([" ", " ", "\n", ".\n\n"], n)))
    templates = {"p": ["a b a b c", "b a"], "q": ["c a a b b a c a b"], "one": ["a"]}
    texts = [text("abcd", int(rng.integers(0, 40))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    for threshold in (0.4, 0.7, 1.0):
        got = {}
        for r in scan(df, templates, threshold=threshold, inside=True).collect():
            got.setdefault(r.doc_id, {})[r.license] = r.score
            assert texts[r.doc_id][r.start :].lstrip().startswith(r.passage)
            assert max(2 * (Counter(zip(words(r.passage), words(r.passage)[1:])) & Counter(zip(words(t), words(t)[1:]))).total()
                       / (len(words(r.passage)) + len(words(t)) - 2) for t in templates[r.license]) == pytest.approx(r.score)
        expected = {i: b for i, t in enumerate(texts) if (b := brute_inside(t, templates, threshold))}
        assert got.keys() == expected.keys() and expected
        for i, best in expected.items():
            assert got[i] == pytest.approx(best)


def test_query_finds_licences_within_documents(spark, tmp_path):
    prose = " ".join(f"word{i}" for i in range(300))
    mit, gpl, bsd = (TEMPLATES[x][1] for x in ("MIT", "GPL-3.0", "BSD-2-Clause"))
    cut = lambda t, *at: [t[a:b].strip() for a, b in zip([0, *map(t.index, at)], [*map(t.index, at), len(t)])]
    texts = {
        "MIT": cut(mit, "The above", "THE SOFTWARE"), "GPL-3.0": cut(gpl, "This program is distributed", "You should"),
        "BSD-2-Clause": cut(bsd, "1. ", "2. ", "THIS"),
    }
    rows = [(name, "\n\n".join([prose, *parts, prose])) for name, parts in texts.items()]
    rows += [("line", f"{prose} Released under the MIT License. {prose}"), ("own line", f"{prose}\n Released under the MIT License.\nx"),
             ("none", f"{prose}\n\n{prose}")]
    spark.createDataFrame(rows, "doc_id string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r.doc_id, r.license): r for r in QUERIES["op10_license_scan"](spark, str(tmp_path)).collect()}
    assert found.keys() == {*((x, x) for x in texts), ("line", "MIT"), ("own line", "MIT")}
    assert all(r.score == 1 for r in found.values())
    for name, parts in texts.items():
        assert found[name, name].passage.split("\n\n")[0] == parts[0] and found[name, name].start == len(prose) + 2
    assert found["line", "MIT"].passage == "Released under the MIT License"
    assert found["own line", "MIT"].passage == "Released under the MIT License."
