from __future__ import annotations

from conftest import rows
from tillwatch.llm import url_filter as U
from tillwatch.llm.common import table
from tillwatch.llm.queries import op6_url_filter


def plain(url):
    """host, path, rule and its verdict, by plain string work."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = rest[:min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    best = None
    for rule, verdict in U.RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[0]):
                best = rule, verdict
    return host, path, *(best or (None, None))


def test_query_follows_the_rules(spark, sf):
    urls = {r["page_id"]: r["url"] for r in table(spark, sf, "pages").select("page_id", "url").collect()}
    got = op6_url_filter(spark, sf).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["p_block"] >= 0.5 else "allow"))


URLS = [None, "", "no scheme/x", "http://Example.NET/en/x", "http://net/", "http://net", "http://xnet/a",
        "http://a.example.com/de/", "http://example.com/DE/x", "https://b.org/fr/y?q#f", "x://y.org?fr/",
        "a://b://c.net/", "http://É.Net/ü", "http://[::1]/p", "ftp://h/\\E.*", "http://q.example.com/a\nb?c=d&e",
        "http://n.net/" + "a" * 50_000, "://net/x"]


def test_edges(spark):
    many = [f"http://s{i}.example.{'net' if i % 2 else 'org'}/{'fr' if i % 3 else 'en'}/{i}" for i in range(80)]
    urls = URLS + many + [many[0]]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r["page_id"]: r for r in U.judge(pages).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = plain(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] in ("allow", "block") and verdict in (None, got[i]["verdict"])


def test_one_class_none_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/"), (3, None)], "page_id long, url string")
    assert rows(U.judge(pages), "page_id", "verdict") == [(1, "block"), (2, "block"), (3, "block")]
    assert rows(U.judge(pages.filter("page_id > 1")), "verdict") == [("allow",), ("allow",)]
    assert U.judge(pages.limit(0)).count() == 0


def test_trees_learn_lexical_differences(spark):
    data = [(i, f"http://{'win-cash-' if i % 2 else ''}site{i}.example/{'9' * (i % 2 * 12)}{i}") for i in range(400)]
    rules = [(f"{u.split('://')[1].split('/')[0]}/", "block" if i % 2 else "allow") for i, u in data[:60]]
    pages = spark.createDataFrame(data, "page_id long, url string")
    got = U.judge(pages, rules).filter("rule is null").collect()
    assert sum((r["verdict"] == "block") == (r["page_id"] % 2 == 1) for r in got) >= 0.95 * len(got)
