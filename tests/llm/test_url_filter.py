from __future__ import annotations

import math
import re
from collections import Counter

import pytest

import __spark_entry__ as contract
from querylens.llm import url_filter
from querylens.llm.queries import QUERIES

SCHEMA = "page_id long, url string, host string, score string"


def expected(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]) if found else ""
    path = found[2] if found else ""
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, rule and rule.text, rule and ("block" if rule.block else "allow")


def judged(spark, urls):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], SCHEMA)
    return sorted(url_filter.judge_urls(pages).collect())


def check(rows, urls):
    for r in rows:
        host, path, rule, verdict = expected(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and verdict in (None, r.verdict)
        assert 0 <= r.score <= 1


def test_rules(spark):
    urls = [
        "http://Example.COM/en/x", "http://www.example.com/en/", "http://a.www.example.com/en/1?q", "http://example.com/enx",
        "http://x.net/es/1", "http://net/fr/", "http://x.net/de/", "http://notnet/es/", "http://example.com", "http://example.com?x=/en/",
        "http://example.com/EN/", "example.com/en/", None, "", "://", "a://b://c/d", "http://é.com/\n/x", "http://x.org/" + "a/1" * 5000,
        "http://x.net/es/1", "HTTPS://u:p@x.com:80/",
    ]
    rows = judged(spark, urls)
    assert len(rows) == len(urls)
    check(rows, urls)
    assert rows[4][2:] == rows[18][2:]


def test_query(spark):
    rows = QUERIES["op7_url_filter"](spark, contract.SMOKE_DIR).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{contract.SMOKE_DIR}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    check(rows, urls)
    # The trees learnt what the rules do.
    known = [r for r in rows if r.rule]
    assert sum((r.score >= 0.5) == (r.verdict == "block") for r in known) >= 0.95 * len(known)


def test_features(spark):
    url = "https://www.ab-c1.example.org/en/x/12.html?a=1&b=2#top"
    row = url_filter.lexical(spark.createDataFrame([(url,), (None,)], "url string")).collect()
    counts = Counter(url)
    entropy = -sum(n / len(url) * math.log2(n / len(url)) for n in counts.values())
    assert row[0].entropy == pytest.approx(entropy)
    assert row[0].digit_ratio == pytest.approx(sum(c.isdigit() for c in url) / len(url))
    got = (row[0].depth, row[0].labels, row[0].parameters, row[0].hyphens, row[0].has_fragment, row[0].is_https)
    assert got == (3, 4, 2, 1, 1, 1)
    assert (row[0].suffix, row[0].domain, row[0].first_folder) == ("org", "example.org", "en")
    assert (row[1].length, row[1].entropy, row[1].depth) == (0, 0, 0)


def test_without_two_kinds_of_labels(spark):
    assert {r.verdict for r in judged(spark, ["http://x.org/", "http://y.org/a"])} == {"allow"}
    rows = judged(spark, ["http://x.net/es/", "http://y.org/a"])
    assert [r.verdict for r in rows] == ["block", "block"]
    assert judged(spark, []) == []
