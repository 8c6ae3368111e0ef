"""URL verdicts against the rules alone and all-pairs classes of links."""

from collections import Counter

from splitlens.llm import url_filter as U
from splitlens.llm.common import table
from splitlens.llm.components import connected_components
from splitlens.llm.queries import URL_RULES
from tests.conftest import SF_SMALL
from tests.llm import brute


def canonical(href):
    return f'<html><head><LINK href="{href}" rel=canonical></head>'


def refresh(href):
    return f"<meta content='0; URL={href}' http-equiv='Refresh'>"


ROWS = [
    (1, "http://a.org/x", canonical("http://b.org/y")),                 # alias of a blocked page
    (2, "http://b.org/y", refresh("https://bad.net/z?q=1")),
    (3, "http://B.org/y#part", None),                                   # the same node as 2
    (4, "http://c.org/fr/k", canonical("http://bad.net/")),             # explicit allow stays
    (5, "http://d.org/k", canonical("http://c.org/fr/k")),              # blocked through 4's component
    (6, "http://e.org/k", canonical("http://f.org/k")),                 # a component without a block
    (7, "http://f.org/k", ""),
    (8, "https://www.example.net/en/1", "<p>"), (9, "https://EXAMPLE.NET/de/", "<p>"), (10, "https://example.com/de/x", "<p>"),
    (11, "https://notexample.com/de/x", "<p>"), (12, "http://net/", "<p>"), (13, "http://dotnet/", "<p>"), (14, None, canonical("http://bad.net/")),
    (15, "no scheme", "<p>"), (16, "", ""), (17, "http://g.org", canonical("//bad.net/a")), (18, "http://h.net?x/en/", "<p>"),
    (19, "http://i.org/a", canonical("/b")), (20, "http://i.org/b", canonical("https://x.net/")), (None, "http://i.org/b", None),
    (20, "http://i.org/b", canonical("https://x.net/")), (21, "http://j.org/a?u=1&v=2", "<p>"),
    (22, "http://k.org/", canonical("http://j.org/a?u=1&amp;v=2") + refresh("http://bad.net/")), (23, "http://l.org/" + "p" * 9000, "<p>" * 90000),
    (24, "http://m.org/", '<link rel="stylesheet" href="http://bad.net/s.css"><a href="http://bad.net/">'),
    (25, "ftp://n.org/\nx", "<p>"), (26, "http://:80/x", "<p>"),
]
BLOCKED_BY_ALIAS = {1, 2, 3, 5, 17, 19, 20, None, 21, 22}


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", 1) for i, u, h in rows], "page_id long, url string, html string, node string, n int")


def test_planted_aliases(spark):
    want = Counter()
    for i, url, _ in ROWS:
        host, path, rule, action = brute.verdict(url, URL_RULES)
        want[(i, host, path, rule, action or ("block" if i in BLOCKED_BY_ALIAS else "allow"))] += 1
    got = Counter(tuple(r) for r in U.filter_urls(frame(spark, ROWS), URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == want


RELATIVE = [
    ("http://a.org/p1", refresh("p2"), "http://a.org/p2"), ("http://a.org/d/e/p?x=/y", canonical("../x"), "http://a.org/d/x"),
    ("http://a.org/d/p?id=1", canonical("?id=3"), "http://a.org/d/p?id=3"), ("http://a.org", canonical("x/./y/."), "http://a.org/x/y/"),
    ("http://A.org/d/", refresh("../../../z?u=../q#f"), "http://a.org/z?u=../q"), ("http://a.org/d/p", canonical("/k/../m"), "http://a.org/m"),
    ("http://a.org/p", canonical("q?to=http://b.org/"), "http://a.org/q?to=http://b.org/"), ("https://a.org/p", canonical("//b.org/x"), "https://b.org/x"),
    ("http://a.org/p", canonical("it's here"), "http://a.org/it's here"), ("http://a.org/p", canonical("a>b"), "http://a.org/a>b"),
    ("http://a.org/p", """<meta http-equiv="refresh" content="3; url='b c'; x">""", "http://a.org/b c"),
    ("http://a.org/p", '<meta http-equiv=refresh content="0;url=it\'s"><p>', "http://a.org/it's"), ("http://a.org/p", "<link rel=canonical href=x/y>", "http://a.org/x/y"),
    ("http://a.org/p", '<base target=_top href="/folder/">' + canonical("x"), "http://a.org/folder/x"),
    ("http://a.org/p", canonical("") + canonical("#top") + canonical("mailto:x") + canonical("./p"), None), ("no scheme", canonical("x"), None), (None, canonical("x"), None),
]


def test_relative_and_quoted_targets(spark):
    for url, html, want in RELATIVE:
        got = [r["b"] for r in U.link_edges(frame(spark, [(1, url, html)])).collect()]
        assert got == ([want] if want else []), (url, html)


def test_block_through_a_relative_refresh(spark):
    rows = [(1, "http://a.org/p1", refresh("p2")), (2, "http://a.org/p2", canonical("http://bad.net/")), (3, "http://a.org/p3", None)]
    got = {r["page_id"]: r["verdict"] for r in U.filter_urls(frame(spark, rows), URL_RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}


def test_hot_canonical_target(spark):
    """Thousands of pages name one blocked page."""
    rows = [(i, f"http://s{i}.org/", canonical("http://hub.org/")) for i in range(3000)] + [(9999, "http://hub.org/", refresh("http://bad.net/"))]
    got = U.filter_urls(frame(spark, rows), URL_RULES)
    assert got.where("verdict = 'block'").count() == 3001


def test_whole_table(spark):
    pages = table(spark, SF_SMALL, "pages", "page_id", "url", "html")
    got = {r["page_id"]: tuple(r)[1:] for r in U.filter_urls(pages, URL_RULES).collect()}
    for i, url, _ in pages.collect():
        host, path, rule, action = brute.verdict(url, URL_RULES)
        assert got[i] == (host, path, rule, action or "allow")


def test_empty_table(spark):
    assert U.filter_urls(frame(spark, []), URL_RULES).collect() == []


def test_components_of_paths_stars_and_cliques(spark):
    edges = ([(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 400)] + [(a, b) for a in range(20) for b in range(a)]
             + [(5, 5), (None, 3), (900, 901), (901, 900), (900, 901)])
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 0 for k in [*range(20), *range(200, 400)]} | {900: 900, 901: 900}
    assert got == want


def test_query_equals_its_sql_on_planted_links(spark, tmp_path):
    """The rows above, and every relative, quoted or <base> target once with a page behind it that is blocked."""
    import duckdb

    from splitlens.llm import queries

    rows = [r for r in ROWS if r[0] != 23]
    for k, (url, html, want) in enumerate(RELATIVE):
        site = f"http://s{k}.org"
        rows.append((1000 + k, url and url.replace("http://a.org", site).replace("http://A.org", site).replace("https://a.org", site), html))
        if want:
            rows.append((2000 + k, want.replace("http://a.org", site).replace("https://b.org", "http://b.org"), canonical("http://bad.net/")))
    frame(spark, rows).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(queries.oracle_sql()["op9_url_filter"])
    got = queries.op9_url_filter(spark, str(tmp_path))
    assert sorted(want.columns) == sorted(got.columns)
    found = Counter(tuple(r[c] for c in want.columns) for r in got.collect())
    assert found == Counter(want.fetchall())
    blocked = {r["page_id"] for r in got.collect() if r["verdict"] == "block" and r["rule"] is None}
    assert len([i for i in blocked if i is not None and 1000 <= i < 2000]) >= 10
