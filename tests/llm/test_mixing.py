import re

import pytest
from brute import targets

from shopledger.llm.mixing import mix


def test_odd_rows(odd, odd_rows):
    rows = mix(odd).collect()
    assert len(rows) == len(odd_rows)
    sizes = {}
    for _, text, _, source in odd_rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    wanted = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        share = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(share), int(share) + 1)
    assert len({r.copies for r in rows if r.doc_id == 6}) == 1


def test_sources_meet_their_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i * 7919 % 400), f"s{i % 3 if i % 2 else 0}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mix(df).toPandas()
    by_source = first.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), largest=("size", "max"))
    assert ((by_source.target - by_source.taken).abs() <= by_source.largest / 2 + 1e-6).all()
    assert first.taken.sum() == pytest.approx(1.5 * first["size"].sum(), rel=0.002)
    again = mix(df.repartition(11, "text")).toPandas()
    key = ["doc_id", "taken"]
    assert first[key].sort_values("doc_id").values.tolist() == again[key].sort_values("doc_id").values.tolist()


def test_expected_copies(spark):
    """Over many documents of one size, about the fractional part of them is taken once more."""
    df = spark.createDataFrame([(i, "a b", "x") for i in range(1000)], "doc_id long, text string, source string")
    assert mix(df, share=1.3).toPandas().copies.value_counts().to_dict() == {1: 700, 2: 300}


@pytest.mark.parametrize("share, limit", [(0, 2), (2, 2), (3, 2), (0.5, 1)])
def test_extreme_shares(spark, share, limit):
    df = spark.createDataFrame([(i, "a " * i, f"s{i % 4}") for i in range(60)], "doc_id long, text string, source string")
    out = mix(df, share=share, limit=limit).toPandas()
    sizes = out.groupby("source")["size"].sum().to_dict()
    wanted = targets(sizes, share=share, limit=limit)
    assert out.groupby("source").target.first().to_dict() == pytest.approx(wanted)
    assert (out.copies <= limit).all()


def test_empty_table_and_plan(odd):
    assert mix(odd.limit(0)).collect() == []
    assert not re.search("Python|Arrow|Pandas", mix(odd)._jdf.queryExecution().executedPlan().toString())
    with pytest.raises(ValueError):
        mix(odd, weights=(1, 0))
