import re

from siltworks.llm.queries import URL_RULES, op4_url_filter
from siltworks.llm.url_filter import url_filter


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host, rest = re.match(r"([^/?#]*)(.*)", url[at + 3 :], re.S).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest)[0]


def rule_of(host, path):
    fits = [(len(h + p), h + p, said) for said, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme/en/", "http://", "http://a.COM/en/x?q=/en/#f", "https://example.com/en/71", "https://EXAMPLE.com/en/7?x", "http://notexample.com/en/7", "http://x.example.net/de/8/9", "http://net/de/", "http://netx/de/",
    "http://É.org/es/", "http://a.org?/es/", "http://a.org#/es/", "http://a.org/es", "a://b://c.com/en/", "http://com/en/\nnext", "http://x/" + "y" * 100_000, "http://a.org/es/1", "http://a.org/es/1",
]


def test_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, score int")
    rows = url_filter(pages, URL_RULES).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        rule, verdict = rule_of(*parts(r["url"]))
        assert (r["host"], r["path"]) == parts(r["url"]) and r["rule"] == rule
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def test_no_labels_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.example/x")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter(pages, URL_RULES).collect()] == ["allow"]
    assert url_filter(pages.limit(0), URL_RULES).count() == 0


def test_trees_learn_from_labels(spark):
    kinds = [(f"http://shop{i}.example/p?a={i}&b={i}&c={i}&d={i}", 1) for i in range(150)] + [(f"https://paper{i}.example/essays/on-words", 0) for i in range(150)]
    labelled = spark.createDataFrame(kinds[:100] + kinds[150:250], "url string, blocked int")
    held_out = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(kinds[100:150] + kinds[250:])], "page_id long, url string, y int")
    rows = url_filter(held_out, [], labelled).collect()
    assert sum((r["verdict"] == "block") == (r["y"] == 1) for r in rows) >= 0.95 * len(rows)


def test_query_on_all_pages(spark, sf):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op4_url_filter(spark, sf).collect()
    assert {r["page_id"] for r in rows} == set(urls) and len(rows) == len(urls)
    for r in rows:
        rule, verdict = rule_of(*parts(urls[r["page_id"]]))
        assert (r["host"], r["path"], r["rule"]) == (*parts(urls[r["page_id"]]), rule) and (not rule or r["verdict"] == verdict)
