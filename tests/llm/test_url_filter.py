import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

from hiretide.llm import queries, url_filter

URLS = [
    "https://a.example.net/en/1", "https://a.example.net/de/1", "HTTP://A.Example.NET/en/x?q#f", "net://net/",
    "https://net", "https://net?x", "https://example.com/de/", "https://example.com/de", "https://xexample.com/de/1",
    "https://m.example.com/de/1", "https://org/fr/", "https://www.Ä.org/fr/é", "https://org/FR/", "no scheme",
    "", None, "://", "a://b://c/d", "https://x.com#://net/", "https://listed.com/a?utm_source=f&b=2&a=1#top",
    "https://www.listed.com:443/a.html?a=1&b=2", "http://listed.com/a", "https://listed.org/fr/1",
    "https://exam\nple.net/en/1", "https://" + "a." * 300 + "net/" + "p" * 5000, "https://net/", "https://net/"]


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def rule_of(url, rules=url_filter.RULES):
    host, path = host_path(url)
    fits = [(len(h + p), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def judged(spark, urls, listed, **more):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([(u,) for u in listed], "url string")
    return {r.page_id: r for r in url_filter.judge_urls(df, listed, **more).collect()}


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert difference(queries.op13_url_filter(spark, sf), connect(sf),
                      queries.ORACLE_SQL["op13_url_filter"]) is None


def test_rules_hosts_and_paths(spark):
    got = judged(spark, URLS, [])
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        verdict, rule = rule_of(url)
        assert (got[i].host, got[i].path) == host_path(url), url
        assert (got[i].rule, got[i].verdict) == (rule, verdict or "allow"), url
        assert not got[i].listed


def test_listed_urls_in_any_form(spark):
    got = judged(spark, URLS, ["http://listed.com/a/?b=2&a=1&ref=z", "https://listed.org/fr/1", None, "x", "://"])
    assert [URLS[i] for i, r in sorted(got.items()) if r.listed] == [
        "https://listed.com/a?utm_source=f&b=2&a=1#top", "https://www.listed.com:443/a.html?a=1&b=2",
        "https://listed.org/fr/1"]
    assert [r.verdict for _, r in sorted(got.items()) if r.listed] == ["block", "block", "allow"]  # a rule stands above


def test_rules_of_any_path_length_and_ties(spark):
    rules = (("a.b", "", "allow"), ("b", "/x", "block"), ("a.b", "/xy", "block"), ("a.b", "/xy", "allow"))
    urls = ["s://a.b", "s://a.b/x", "s://c.b/xyz", "s://a.b/xyz", "s://b/", "s://c.a.b/q"]
    got = judged(spark, urls, [], rules=rules)
    assert [(got[i].rule, got[i].verdict) for i in range(6)] == [
        ("a.b", "allow"), ("a.b", "allow") if rule_of(urls[1], rules)[1] == "a.b" else ("b/x", "block"),
        ("b/x", "block"), ("a.b/xy", "block"), (None, "allow"), ("a.b", "allow")]
    assert judged(spark, ["s://a.b/x"], [], rules=())[0].verdict == "allow"


def test_bloom_keeps_all_listed_and_few_others(spark):
    listed = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    other = spark.range(20000).select(F.concat(F.lit("o"), "id").alias("key"))
    assert url_filter.possible_hits(listed, listed).count() == 20000
    assert url_filter.possible_hits(other, listed).count() < 100


@pytest.mark.parametrize("most", [0, url_filter.MOST_BROADCAST])
def test_large_filters_are_joined_and_not_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MOST_BROADCAST", most)
    listed = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = url_filter.possible_hits(listed, listed)
        assert df.count() == 5000
        text = df._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in text) == bool(most) and "CartesianProduct" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "s://net/", "a"), (1, "s://net/", "b"), (1, "s://net/", "c"), (2, None, "d")],
                               "page_id long, url string, row string").withColumns(
        {c: F.lit("z") for c in ("host", "key", "block", "rule", "verdict", "listed", "canonical", "id", "w0")})
    got = url_filter.judge_urls(df, df.select("url"))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "listed"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, "net", "/", "net/", "block", True), (1, "net", "/", "net/", "block", True),
         (1, "net", "/", "net/", "block", True), (2, "", "", None, "allow", False)], key=str)
    assert url_filter.judge_urls(df.filter("1 = 0"), df).collect() == []
    assert url_filter.judge_urls(df, df.filter("1 = 0")).count() == 4


def test_html_is_not_read(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = url_filter.listed_keys(pages, url_filter.RULES)
    assert "ReadSchema: struct<url:string>" in rows._jdf.queryExecution().executedPlan().toString()
