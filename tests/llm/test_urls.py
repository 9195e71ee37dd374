import re

from pyspark.sql import types as T

from tests.llm.helpers import empty
from tidemark.llm import queries, urls
from tidemark.session import few_rows

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/1", "http://example.net/EN/", "x://net", "x://net/",
    "http://deep.sub.example.com/de/a?b#c", "http://example.com/den", "http://fr.org/fr/x", "http://forg/fr/x",
    "http://example.com#frag/de/", "http://h?q=/de/", "http://ünï.NET/ä\n/b", "a://b://c/d", "http://example.com/de/" + "x/" * 5000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in queries.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def rules(spark):
    return few_rows(spark, queries.RULES, T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "verdict")]))


def no_labels(spark):
    return spark.createDataFrame([], "page_id long, bad boolean")


def test_rules_against_plain(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS bad")
    for r in urls.judge_urls(pages, rules(spark), no_labels(spark)).collect():
        host, path, rule, verdict = plain(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict


def test_templates_merge_and_bad_ones_go(spark):
    rows, bad = [], []
    for k in range(60):
        rows += [(f"http://h.x/good/{k}", False), (f"http://h.x/news/{k}/view", False), (f"http://h.x/pills/{k}", True)]
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(rows) if k % 2], "page_id long, bad boolean")
    found = urls.judge_urls(pages, rules(spark), labels).collect()
    for r in found:
        assert (r["verdict"] == "block") == ("/pills/" in r["path"])
    assert {r["template"] for r in found if "/pills/" in r["path"]} == {"/pills/*"}


def test_bad_ones_go_at_any_depth(spark):
    rows = []
    for k in range(60):
        rows += [(f"http://h.x/2024/en/a/b/c/good/{k}", False), (f"http://h.x/2024/en/a/b/c/news/{k}", False)]
        rows += [(f"http://h.x/2024/en/a/b/c/pills/{k}", True), ("http://h.x/" + "x/" * 3000 + str(k), False)]
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(rows) if k // 4 % 2], "page_id long, bad boolean")
    found = urls.judge_urls(pages, rules(spark), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["verdict"] == "block") == ("/pills/" in r["path"])
    assert len({r["template"] for r in found if "/pills/" in r["path"]}) == 1


def test_empty(spark):
    table = empty(spark).selectExpr("doc_id AS page_id", "text AS url")
    assert urls.judge_urls(table, rules(spark), no_labels(spark)).count() == 0
