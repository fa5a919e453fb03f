"""Rules against a plain walk; the Bloom filter never loses a listed key."""

import re

import pytest
from pyspark.sql import functions as F

from isoquilt.llm import url_filter
from isoquilt.llm.queries import URL_RULES

URLS = [
    None, "", "nourl", "http://", "http://WWW.Example.COM/en/x?y", "http://WWW.Example.COM/en/x?y", "http://com",
    "ftp://a.net/es/?q#://z.com/", "https://net/fr/", "http://xnet/es/", "http://" + "a." * 4000 + "example.com/en/",
    "http://example.com/en", "http://blog.example.com/en/1#x", "http://m.org/es/", "x://É.com/", "http://a.net/es/" + "y" * 9000,
]


def _brute(url, rules):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = ("", "") if not found else found.groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in rules:
        r_host, _, r_path = rule.partition("/")
        fits = (host == r_host or host.endswith("." + r_host)) and path.startswith("/" + r_path)
        if fits and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return (host, path, *(best or (None, "allow")))


@pytest.fixture()
def pages(spark):
    rows = [(None if i == 3 else i, u, "x", "y", 1) for i, u in enumerate(URLS)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, host string, rule string, key int")


@pytest.mark.parametrize("extra", [0, 500])
def test_against_brute_force(spark, pages, extra, monkeypatch):
    rows, table = pages
    rules = URL_RULES + [(f"host{i}.org/p{i}/", "block") for i in range(extra)]
    want = sorted(str((p, *_brute(u, rules))) for p, u, *_ in rows)
    listed = url_filter.listed_entries(spark, rules)
    assert sorted(str(tuple(r)) for r in url_filter.judge(table, listed).collect()) == want
    # a filter of one block passes nearly everything on, and the join still decides
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", 0)
    assert sorted(str(tuple(r)) for r in url_filter.judge(table, listed).collect()) == want


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("key"))
    words = url_filter.bloom_filter(keys, 190).first()["words"]
    column = F.array(*[F.lit(w) for w in words])
    others = spark.range(3000, 6000).select(F.concat(F.lit("h"), "id").alias("key"))
    assert keys.where(~url_filter._may_hold(column, F.col("key"), 190)).count() == 0
    assert others.where(url_filter._may_hold(column, F.col("key"), 190)).count() < 300


def test_empty(spark, pages):
    listed = url_filter.listed_entries(spark, URL_RULES)
    assert url_filter.judge(pages[1].limit(0), listed).count() == 0
    none = url_filter.judge(pages[1], listed.limit(0)).collect()
    assert len(none) == len(URLS) and {r["verdict"] for r in none} == {"allow"}
    plan = url_filter.judge(pages[1], listed)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
