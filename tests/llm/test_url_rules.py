import random

import pytest
from pyspark.sql import functions as F

from wickwork.llm import url_rules
from wickwork.llm.queries import QUERIES, URL_RULES

RULES = "verdict string, host string, path string"


def plain(url, rules, otherwise="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [rest.find(c) for c in "/?#" if c in rest]
        host, path = rest[: min(ends, default=len(rest))], rest[min(ends, default=len(rest)) :]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h) + len(p or ""), len(h), v, h + (p or ""))
        for v, h, p in rules
        if v and h and host and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    if not fits:
        return host, path, None, otherwise
    best = max(fits)
    return host, path, best[3], best[2]


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = url_rules.judge_urls(pages, spark.createDataFrame(rules, RULES), **options)
    return {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in found.collect()}


def test_against_all_pairs(spark):
    rng = random.Random(5)
    labels, parts = ["a", "b", "co", "org", "x-y", "ü"], ["", "e", "en", "en/1", "/", "z", "en/\U0010ffff"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "/".join(rng.choice(parts) for _ in range(rng.randrange(3)))
    rules = [(rng.choice(["allow", "block"]), host(), rng.choice([path(), "", None])) for _ in range(150)]
    urls = [rng.choice(["http://", "https://"]) + host().upper() + rng.choice([path(), "", "?q=/en", "#x"]) + rng.choice(["", "?a://b/", "#f"]) for _ in range(800)]
    urls += [None, "", "no scheme", "://", "http:///en/", "a://b://c/", "mailto:x", "http://" + "a." * 300 + "org/", "http://a.org/" + "e" * 50_000]
    got = judged(spark, urls, rules, otherwise="block")
    assert got == {k: plain(u, rules, "block") for k, u in enumerate(urls)}


def test_labels_are_whole_and_longest_wins(spark):
    rules = [("block", "org", "/"), ("allow", "example.org", "/en/"), ("block", "example.org", "/en/1"), ("allow", "example.org", "/en/1")]
    urls = ["http://badexample.org/en/1", "http://www.EXAMPLE.org/en/2", "http://example.org/en/12?x", "http://example.org", "http://organic/"]
    assert [v[2:] for _, v in sorted(judged(spark, urls, rules).items())] == [
        ("org/", "block"),
        ("example.org/en/", "allow"),
        ("example.org/en/1", "block"),
        (None, "allow"),
        (None, "allow"),
    ]


def test_empty_tables_nulls_and_clashing_columns(spark, clashing):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id bigint, url string")
    none = spark.createDataFrame([], RULES)
    assert url_rules.judge_urls(pages.limit(0), spark.createDataFrame([("block", "org", "/")], RULES)).count() == 0
    assert url_rules.judge_urls(pages, none).first()["verdict"] == "allow"
    unsound = spark.createDataFrame([(None, "org", "/"), ("block", None, "/"), ("block", "", "/"), ("block", "ORG", None)], RULES)
    assert url_rules.judge_urls(pages, unsound).first()["rule"] == "org"
    crowded = clashing(pages, "host", "path", "rule", "verdict", "key", "range", "top", "depth", "h", "p")
    row = url_rules.judge_urls(crowded, unsound).first()
    assert (row["host"], row["verdict"], row["range"], row["h"]) == ("a.org", "block", "extra5", "extra8")


def test_hot_urls_and_hosts_are_spread(spark):
    """One URL and one host with a third of the rows each: no range holds much more than its share."""
    hot = spark.range(20_000).select(F.lit("http://hot.com/").alias("url"))
    host = spark.range(20_000).select(F.concat(F.lit("http://s"), "id", F.lit(".many.com/")).alias("url"))
    other = spark.range(20_000).select(F.concat(F.lit("http://h"), "id", F.lit(".org/p"), F.col("id") % 7).alias("url"))
    urls = hot.union(host).union(other).select(url_rules.url_host(F.col("url")).alias("host"), url_rules.url_path(F.col("url")).alias("path"))
    rules = spark.createDataFrame([("block", "many.com", "/"), ("allow", "com", "/"), ("allow", "h7.org", "/p")], RULES)
    sizes = []
    swept = url_rules._swept

    def watch(events):
        sizes.extend(r["count"] for r in events.groupBy("range").count().collect())
        return swept(events)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(url_rules, "_swept", watch)
        found = url_rules.longest_rules(urls, rules)
        assert found.count() == 20_002
    assert max(sizes) < 3 * sum(sizes) / url_rules.LEAST_RANGES


def test_plan_has_no_python_and_no_cross_join(spark):
    df = QUERIES["op12_url_filters"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))
    rows = {r["page_id"]: tuple(r)[1:] for r in df.collect()}
    urls = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url").collect()
    assert rows == {r["page_id"]: plain(r["url"], URL_RULES) for r in urls}
