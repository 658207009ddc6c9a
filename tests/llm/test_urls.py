from __future__ import annotations

import re

from pyspark.sql import functions as F

from tenura.llm import components, urls
from tenura.llm.queries import URL_RULES
from tests.conftest import rows_of

RULES = "host string, path string, verdict string"


def judged(spark, rules, addresses, edges=()):
    rows = spark.createDataFrame([(a,) for a in addresses], "url string")
    links = spark.createDataFrame(list(edges), "a string, b string")
    found = urls.judge(rows, spark.createDataFrame(rules, RULES), links).collect()
    return {r.url: (r.rule, r.verdict) for r in found}


def test_longest_rule_wins_and_subdomains_fit(spark):
    addresses = [
        "http://example.com/en/1", "http://www.EXAMPLE.com/en/1", "http://a.b.example.com/en/", "http://notexample.com/en/1",
        "http://x.net/es/9", "http://x.net/de/9", "http://net/fr/", "http://x.org/", "http://com", "http://x.com:80/en/",
    ]
    found = judged(spark, URL_RULES, addresses)

    def brute(url):
        host, path = re.match(r"[^:]*://([^/?#]*)([^?#]*)", url).groups()
        host = host.lower()
        fit = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
        return (best[0] + best[1], best[2]) if best else (None, "allow")

    assert found == {a: brute(a) for a in addresses}


def test_block_reaches_aliases_and_allow_takes_precedence(spark):
    rules = [("bad.com", "/", "block"), ("good.com", "/", "allow")]
    edges = [
        ("http://a.org/1", "http://bad.com/x"), ("http://b.org/1", "http://a.org/1"), ("http://c.org/1", "http://b.org/1"),
        ("http://d.org/1", "http://bad.com/y"), ("http://d.org/1", "http://good.com/y"), ("http://bad.com/z", "http://good.com/z"),
    ]
    found = judged(spark, rules, sorted({u for e in edges for u in e} | {"http://lone.org/"}), edges)
    verdict = {u: v for u, (_, v) in found.items()}
    assert {verdict[f"http://{h}.org/1"] for h in "abc"} == {"block"}
    assert verdict["http://d.org/1"] == "allow" and verdict["http://bad.com/z"] == "block"
    assert verdict["http://good.com/z"] == "allow" and verdict["http://lone.org/"] == "allow"


def test_page_edges(spark):
    html = [
        '<html><link href="https://to.org/c" rel="canonical"><body>', "<META HTTP-EQUIV='refresh' CONTENT='0; URL=http://to.org/r'>",
        "<link rel=stylesheet href=https://to.org/css>", None,
    ]
    addresses = ["https://a.org/1", "https://a.org/2", "HTTP://A.org/3/?utm_source=x&p=1#f", None]
    pages = spark.createDataFrame(list(zip(range(4), addresses, html)), "page_id long, url string, html string")
    edges = {(r.a, r.b) for r in urls.page_edges(pages).collect()}
    assert edges == {
        ("https://a.org/1", "https://to.org/c"), ("https://a.org/2", "http://to.org/r"), ("http://to.org/r", "https://to.org/r"),
        ("HTTP://A.org/3/?utm_source=x&p=1#f", "https://a.org/3?p=1"),
    }


def test_odd_pages(spark):
    rules = spark.createDataFrame([*URL_RULES, (None, "/", "block"), ("org", None, "block")], RULES)
    rows = [
        (1, None, "<p>", "a"), (2, "no scheme", None, "b"), (3, "", "", None), (None, "http://x.net/es/1", "", "c"),
        (4, "http://x.net/es/1", "", "c"), (4, "http://x.net/es/1", "", "c"), (5, "://h/p?q", None, "d"), (6, "http://" + "s." * 500 + "net/fr/", "", "e"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    found = urls.judge_pages(pages, rules)
    assert rows_of(found) == sorted(
        [
            ("", 1, "", None, "allow"), ("", 2, "", None, "allow"), ("", 3, "", None, "allow"), ("x.net", None, "/es/1", "net/es/", "block"),
            ("x.net", 4, "/es/1", "net/es/", "block"), ("x.net", 4, "/es/1", "net/es/", "block"), ("h", 5, "/p", None, "allow"),
            ("s." * 500 + "net", 6, "/fr/", "net/fr/", "block"),
        ],
        key=repr,
    )
    assert urls.judge_pages(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_pages(pages, rules.limit(0)).collect()} == {"allow"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    rows = path + star + [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4)]
    found = components.components(spark.createDataFrame(rows, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert found.count() == len(got)
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 560)}, 2: 2, 3: 2}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hosts_and_paths(spark):
    rows = spark.createDataFrame([("a://B.c/p/q?x#y",), ("x://y://z/",), ("http://h\n/p",)], "url string")
    got = rows.select(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("b.c", "/p/q"), ("y:", "//z/"), ("h\n", "/p")]


TARGETS = [
    "http://h.org/x", "//h.org/x?y#z", "/x/../y", "x", "./x/", "../x", "../../../x", "?p=1", "x?a=/../b", "..", ".", "x/./y/../z",
    "/", "https://h.org",
]


def test_targets_are_resolved_on_the_page(spark):
    from urllib.parse import urljoin

    bases = ["http://a.net/fr/deep/page.html?q=1#f", "https://A.net/fr/", "http://a.net/en"]
    rows = [(b, t) for b in bases for t in TARGETS]
    df = spark.createDataFrame(rows, "base string, target string")
    found = df.select("base", "target", urls.resolved(F.col("base"), F.col("target")).alias("url")).collect()
    assert [r.url for r in found] == [urljoin(b, t) for b, t in rows]
    none = spark.createDataFrame([("http://a.net/x", t) for t in ("", "#top", "mailto:a@b.org", "javascript:void(0)")], "base string, target string")
    assert {r[0] for r in none.select(urls.resolved(F.col("base"), F.col("target"))).collect()} == {None}
    bare = spark.createDataFrame([("http://a.net", "x"), ("http://a.net", "/x"), ("http://a.net", "?y")], "base string, target string")
    assert [r[0] for r in bare.select(urls.resolved(F.col("base"), F.col("target"))).collect()] == ["http://a.net/x", "http://a.net/x", "http://a.net?y"]


def test_block_reaches_relative_and_escaped_links(spark):
    pages = [
        ("http://a.net/fr/x", "<link rel=canonical href='/en/x'>"),
        ("http://a.net/fr/y", '<LINK REL="alternate canonical" HREF="http://a.net/en/y?p=1&amp;q=2">'),
        ("http://a.net/fr/z", '<link rel="stylesheet" href="/css"><link rel="canonical" href="../de/z"><meta http-equiv="refresh" content="0;url=//b.org/z">'),
        ("http://a.net/en/x", None), ("http://a.net/en/y?p=1&q=2", ""), ("http://a.net/de/z", "<link "), ("http://b.org/z", "<meta " * 50_000),
        ("http://a.net/css", ""),
    ]
    rules = spark.createDataFrame(URL_RULES, RULES)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    verdict = {r.page_id: r.verdict for r in urls.judge_pages(df, rules).collect()}
    assert verdict == dict.fromkeys(range(7), "block") | {7: "allow"}
    from checks.compare import differences
    import duckdb
    from tenura.llm.queries import ORACLES

    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(i, *p) for i, p in enumerate(pages)])
    assert differences(urls.judge_pages(df, rules), con, ORACLES["op2_url_filters"]) is None
