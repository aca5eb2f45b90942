"""Rules and lists against a plain reading of the URL."""

from __future__ import annotations

import random
import re

import pytest
from helpers import plan_text

from tallygate.llm import common
from tallygate.llm import url_filters as urls

SCHEMA = "page_id bigint, url string, host string, block int, lane0 int, listed int, canonical int"
EXTRA = ("h", 1, 2, 3, 4)


def page_table(spark, listed):
    rows = [(i, url, *EXTRA) for i, url in enumerate(listed)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    best = None
    for rule in urls.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.name) > len(best.name):
                best = rule
    return best


ODD = [
    None, "", "no scheme", "http://", "http://?x", "http:///path", "HTTP://WWW.Example.COM/en/1",
    "https://www.example.com/en/1?a=1#b", "http://example.com/en", "http://example.com/en/",
    "http://aexample.com/en/", "http://a.example.com/en/x", "http://x.net/es/", "http://net/fr/q",
    "http://x.net/de/", "http://y.org/en/", "http://a.com", "http://a.com/", "http://a.com?/en/",
    "x://y://www.example.com/en/", "http://user@A.com:80/p", "//a.com/", "http://é.NET/ES/",
    "http://b.org/a\nb", "http://b.org/a/", "http://b.org/a?utm_source=x", "https://b.org:443/a#t",
    "http://b.org/a?q=1&utm_medium=y", "http://b.org/a?q=1", "http://b.org/a?q=2",
]


def test_parts_rules_and_verdicts(spark):
    pages = page_table(spark, ODD)
    none = pages.where("false").select("url")
    for row in urls.judged(pages, none).collect():
        host, path = parts(ODD[row.page_id])
        assert (row.host, row.path) == (host, path)
        rule = rule_of(host, path)
        assert row.rule == (rule.name if rule else None), ODD[row.page_id]
        assert row.verdict == (rule.verdict if rule else "allow")
        assert not row.listed


def test_spellings_of_a_listed_address(spark):
    pages = page_table(spark, ODD)
    block_list = spark.createDataFrame(
        [("HTTP://B.org/a",), ("http://b.org/a?q=1",), (None,), ("nothing",), ("http://b.org/a",)],
        "url string",
    )
    found = {ODD[r.page_id]: r for r in urls.judged(pages, block_list).collect()}
    listed = {url for url, row in found.items() if row.listed}
    assert listed == {
        "http://b.org/a/", "http://b.org/a?utm_source=x", "https://b.org:443/a#t",
        "http://b.org/a?q=1&utm_medium=y", "http://b.org/a?q=1",
    }
    assert all(found[url].verdict == "block" for url in listed)


def test_a_rule_goes_before_the_list(spark):
    pages = page_table(spark, ["http://www.example.com/en/1", "http://z.org/"])
    row, other = urls.judged(pages, pages.select("url")).orderBy("page_id").collect()
    assert (row.listed, row.verdict) == (True, "allow")
    assert (other.listed, other.verdict) == (True, "block")


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_the_filter_never_loses_and_the_join_is_exact(spark, monkeypatch, bits):
    monkeypatch.setattr(urls, "BITS_PER_URL", bits)
    rng = random.Random(bits)
    addresses = [f"http://h{rng.randrange(50)}.org/{rng.randrange(4000)}" for _ in range(3000)]
    pages = page_table(spark, addresses)
    chosen = set(addresses[:400])
    block_list = spark.createDataFrame([(a,) for a in chosen], "url string")
    rows = urls.judged(pages, block_list).collect()
    assert len(rows) == len(addresses)
    assert all(r.listed == (addresses[r.page_id] in chosen) for r in rows)


def test_no_pages(spark):
    pages = page_table(spark, [])
    assert urls.judged(pages, pages.select("url")).collect() == []


def test_plan_has_no_python_and_a_bounded_broadcast(spark, monkeypatch):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(urls.op3_url_filters(spark, "/root/testdata/sf0.001"))
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
        without = plan_text(urls.op3_url_filters(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for text in (plan, without):
        assert "Python" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BroadcastExchange" in plan and "BroadcastExchange" not in without
