from __future__ import annotations

import pytest

from tiffin.llm.url_filter import RULES, filter_urls, rule_table

URLS = [
    "http://net/", "https://a.net/x", "https://a.net", "http://example.net/en/1", "http://m.example.net/en/",
    "http://EXAMPLE.NET/en/x?y=/de/", "http://example.net/EN/", "http://notexample.net/en/", "http://example.com/de/",
    "http://example.com/de", "http://sub.example.com/de/x#y", "http://example.org/fr/2", "http://org/fr/", "http://org.com/fr/",
    "http://planet/x", "http://x.planet/", "no scheme", "", None, "://net/", "http://", "http://a.net:80/", "http://net?x",
    "http://net2.net/", "http://.net/", "http://net./", "x://y://net/", "http://ünì.net/ß", "http://a.b.c.d.example.net/en/",
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize(
    "rules",
    [
        RULES,
        [("block", "net", ""), ("allow", "example.net", "/en/"), ("block", "m.example.net", "/"), ("allow", "com", "/de/x")],
        [("block", "net", "/"), ("allow", "net", "/"), ("block", "net", "/x")],
        [],
    ],
)
def test_rules(spark, rules):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, path string").repartition(4)
    got = {tuple(r) for r in filter_urls(pages, rule_table(spark, rules)).collect()}
    assert got == {(i, *brute(u, rules)) for i, u in enumerate(URLS)}
    assert filter_urls(pages, rule_table(spark, rules)).count() == len(rows)


def test_hot_host_spreads_over_blocks(spark):
    """Blocks that begin in the middle of one host's pages still know its rules."""
    urls = [(i, f"http://hot.example.net/{'en' if i % 2 else 'de'}/{i}") for i in range(20_000)]
    pages = spark.createDataFrame(urls, "page_id long, url string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = filter_urls(pages, rule_table(spark, RULES)).groupBy("verdict").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["verdict"]: r["count"] for r in got} == {"allow": 10_000, "block": 10_000}


def test_empty_table_and_native_plan(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    out = filter_urls(pages, rule_table(spark, RULES))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_control_characters_in_hosts(spark):
    """The characters that separate keys are letters like any other in a host."""
    rows = [(1, "http://net\x00x/a"), (2, "http://net\x01/a"), (3, "http://a\x00.net/a"), (4, "http://net\x02\x03x/"), (5, "http://net/a")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r["rule"] for r in filter_urls(pages, rule_table(spark, RULES)).collect()}
    assert got == {1: None, 2: None, 3: "net/", 4: None, 5: "net/"}
