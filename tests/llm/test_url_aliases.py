from shopledger.llm.components import components
from shopledger.llm.url_aliases import Rule, judge

RULES = [
    Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("com", "/de/", "block"),
    Rule("com", "/fr/", "allow"), Rule("bad.net", "/", "block"),
]


def link(href):
    return f'<head><LINK  href="{href}" rel="canonical"></head>'


PAGES = [
    (1, "http://a.EXAMPLE.org/es/1?x#y", None), (2, "https://example.org/en", ""), (3, "http://x.com/de/1", "<p>"),
    (4, "http://x.com/en/1", link("/de/1")),  # alias of a blocked page
    (5, "http://y.net/a/b", "<link rel='canonical' href='c?p=1&amp;q=2'>"),
    (6, "http://y.net/a/c?p=1&q=2", '<meta http-equiv="Refresh" content="0; URL=\'//z.net/\'">'),
    (7, "https://z.net/#top", link("https://www.bad.net/")),  # chain 5 - 6 - 7 - bad.net
    (8, "http://x.com/fr/2", link("http://bad.net/")),  # own allow stands
    (9, "http://www.bad.net", None), (10, None, link("http://bad.net/")), (11, "no url", link("http://bad.net/")),
    (12, "http://notbad.net/", link("mailto:a@bad.net")), (13, "://q/r?s", link("")), (14, "http://free.net/", link("#x")),
    (14, "http://free.net/", link("#x")), (None, "http://free.net/?a", link("http://free.net/")),
]


def test_rules_and_aliases(spark):
    df = spark.createDataFrame([(*p, 1, "v") for p in PAGES], "page_id long, url string, html string, node int, verdict string")
    rows = judge(df, RULES).collect()
    assert len(rows) == len(PAGES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en", "org/", "allow")
    assert got[3][2:] == ("com/de/", "block") and got[4][2:] == (None, "block")
    assert [got[i][2:] for i in (5, 6, 7)] == [(None, "block")] * 3
    assert got[8][2:] == ("com/fr/", "allow")
    assert got[9] == ("www.bad.net", "", None, "allow")  # its empty path doesn't begin with "/", and nobody names it
    assert got[10] == got[11] == ("", "", None, "allow")
    assert got[12][3] == got[13][3] == got[14][3] == got[None][3] == "allow"
    assert got[13][:2] == ("q", "/r")
    assert judge(df.limit(0), RULES).collect() == []


def test_redirect_table(spark):
    df = spark.createDataFrame([(1, "http://one.net/", None), (2, "http://two.net/", None)], "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://one.net/", "http://bad.net/"), (None, "x"), ("http://two.net/", None)], "from_url string, to_url string")
    assert {r.page_id: r.verdict for r in judge(df, RULES, redirects=moved).collect()} == {1: "block", 2: "allow"}


def test_components(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    edges = path + star + star + [(5000, 5000), (6000, None), (7001, 7000)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r.node: r.component for r in rows}
    assert len(rows) == len(got) == 201 + 300 + 2
    assert all(got[i] == 0 for i in range(201)) and all(got[i] == 1000 for i in range(1000, 1300)) and got[7001] == 7000
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_statement_says_the_same(spark):
    import duckdb
    import pandas as pd

    from shopledger.llm.statements import url_aliases

    pages = pd.DataFrame(PAGES, columns=["page_id", "url", "html"])  # noqa: F841
    expected = duckdb.sql(url_aliases(RULES)).fetchall()
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = [tuple(r) for r in judge(df, RULES).select("page_id", "host", "path", "rule", "verdict").collect()]
    plain = lambda rows: sorted(tuple(None if x != x else x for x in r) for r in rows if r[0] == r[0] and r[0])
    assert plain(got) == plain(expected)
