import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blocklake.llm import urls
from tests.llm.fixtures import LOWER

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("com", "", "block"), ("b.example.com", "/de/x", "allow"), ("example.com", "/de/x/y", "block"), ("example.com", "/de/x/y", "allow"),
    (None, None, "block"), ("org", "/fr/", "allow"), ("de", "/q", None), ("fr", "no-slash", "block"), ("a/b", "/", "block"), ("EXAMPLE.org", "/", "block"), ("x.org", None, "block"), ("é.org", "/ü/", "block"),
]


def brute(url, rules=RULES, otherwise="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host, rest = rest[:end].translate(LOWER), rest[end:]
        path = rest[: min([k for k in (rest.find(c) for c in "?#") if k >= 0], default=len(rest))]
    fits = [(len(h) + len(p), len(h), h, p, v) for h, p, v in ((h or "", p or "", v) for h, p, v in rules) if v and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2] + best[3], best[4] if best else otherwise


def addresses():
    r = random.Random(3)
    hosts = ["example.net", "www.example.net", "a.b.example.com", "b.example.com", "EXAMPLE.com", "notexample.com", "x.org", "org", "net", "net:80", "me@x.net", "é.org", "", "dot.", ".com", "fr"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/de/x/y", "/de/x/yz/1", "/fr//", "/ü/1", "/EN/", "/q", "//", "/a\nb/"]
    tails = ["", "?page=2&ref=http://z.net/", "#top", "?a#b"]
    out = [f"{r.choice(['http', 'HTTPS', ''])}://{h}{p}{t}" for h in hosts for p in paths for t in tails]
    return [*out, None, "", "example.net/en/", "://", "http://example.net?x=/en/", "http://" + "l." * 3000 + "net" + "/p" * 3000, *["http://hot.example.net/en/1"] * 300]


@pytest.mark.parametrize("limits", [{}, {"most_bytes": 0}, {"most_shapes": 1}])
@pytest.mark.parametrize("prefix", [8, 1])
def test_judge_against_brute_force(spark, monkeypatch, limits, prefix):
    monkeypatch.setattr(urls, "PREFIX", prefix)  # with one digit most rules share their prefix: digests decide
    rows = addresses()
    pages = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(rows)], "page_id long, url string, digest string").withColumn("prefix", F.lit(1)).withColumn("rules", F.lit("own")).withColumn("best", F.lit(2)).withColumn("salt", F.lit(5))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = urls.judge(pages, rules, **limits)
    assert got.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    found = got.collect()
    assert {(r.digest, r.prefix, r.rules, r.best, r.salt) for r in found} == {("kept", 1, "own", 2, 5)}
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found) == Counter((i, *brute(u)) for i, u in enumerate(rows))


@pytest.mark.parametrize("limits", [{}, {"most_bytes": -1}])
def test_no_rules_no_pages_and_repeated_rows(spark, limits):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([("http://a.net/",), ("http://a.net/",), (None,)], "url string")
    got = urls.judge(pages, rules, otherwise="unknown", **limits).collect()
    assert Counter((r.host, r.path, r.rule, r.verdict) for r in got) == {("a.net", "/", None, "unknown"): 2, ("", "", None, "unknown"): 1}
    four = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    assert Counter(r.verdict for r in urls.judge(pages, four, **limits).collect()) == {"block": 2, "allow": 1}
    assert urls.judge(pages.limit(0), four, **limits).count() == 0


def test_allowed_keeps_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "h"), (2, "http://www.example.net/en/", "h"), (3, None, "h")], "Verdict long, url string, host string")
    kept = urls.allowed(pages, spark.createDataFrame(urls.RULES, "host string, path string, verdict string"))
    assert kept.columns == pages.columns and sorted(r.Verdict for r in kept.collect()) == [2, 3]
    with pytest.raises(ValueError):
        urls.judge(pages, pages)


def test_query_sends_no_page_through_an_exchange(spark):
    plan = urls.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Python" not in plan and plan.count("BroadcastHashJoin") == 3
