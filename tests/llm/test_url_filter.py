import pytest
from pyspark.sql import functions as F

from civicflow.llm import url_filter as uf
from tests.llm import brute
from tests.llm.helpers import sf

URLS = [None, "", "no scheme", "://", "http://", "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/x", "http://www.example.com/fr/",
        "http://a.b.example.com/en/", "http://notexample.com/en/", "http://example.com", "http://example.com?x=/en/", "http://x.net/es/1", "http://net/fr/",
        "http://x.net/es", "http://xnet/es/", "http://x.org/a.html", "http://m.x.org/a/", "http://x.org/a#top", "ftp://x.org/a?b=c://d", "http://com", "http://com/",
        "http://ÉX.com/É", "http://x.org\n/y\n?z", "a://b://c.com/x"]


def canonical(url):
    host, path = brute.url_parts(url)
    for p in ("www.", "m."):
        if host.startswith(p):
            host = host[len(p):]
            break
    for s in ("/", ".html"):
        if path.endswith(s):
            path = path[:-len(s)]
            break
    return host + path


def judge(spark, urls, listed):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for c in ("key", "block", "hit", "rule", "lane_0"):
        df = df.withColumn(c, F.lit("own"))
    return {r.page_id: r for r in uf.blocked(df, spark.createDataFrame([(u,) for u in listed], "url string")).collect()}


@pytest.mark.parametrize("listed", [[], ["x.org/a", "x.org/a", None, "", "example.com"], [f"h{i}.org/p{i}" for i in range(3000)] + ["x.org/a"]])
def test_against_brute_force(spark, listed):
    got = judge(spark, URLS, listed)
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = brute.url_parts(u)
        rule, hit = brute.url_rule(host, path), canonical(u) in listed and canonical(u) != ""
        want = brute.RULES[rule] if rule else "block" if hit else "allow"
        assert (got[i].host, got[i].path, got[i].rule, got[i].listed, got[i].verdict) == (host, path, rule, hit, want), u


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = [f"h{i}.org/p" for i in range(2000)]
    got = judge(spark, [f"http://{u}" for u in listed] + [f"http://g{i}.org/p" for i in range(4000)], listed)
    assert all(got[i].possible and got[i].listed and got[i].verdict == "block" for i in range(2000))
    assert not any(got[i].listed for i in range(2000, 6000)) and sum(got[i].possible for i in range(2000, 6000)) < 80


def test_tables(spark):
    from civicflow.llm.queries import op9_url_filter

    pages = {r.page_id: r.url for r in sf(spark, "pages").collect()}
    listed = {canonical(u) for p, u in pages.items() if p % 100 == 0}
    got = op9_url_filter(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = brute.url_parts(pages[r.page_id])
        rule = brute.url_rule(host, path)
        assert (r.host, r.path, r.rule, r.listed) == (host, path, rule, canonical(pages[r.page_id]) in listed)


def test_empty(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert uf.blocked(empty, empty.select("url")).collect() == []
