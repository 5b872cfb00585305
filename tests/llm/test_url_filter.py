import itertools

from pyspark.sql import functions as F

from stayrate.llm import url_filter
from stayrate.llm.queries import RULES

URLS = [
    "http://www.Example.ORG/en/17?x", "https://example.org/es/9", "http://a.org", "http://a.org/", "ftp://b.com/fr/x", "http://b.com/de/",
    "http://b.com/fr", "http://notexample.org/es/1", "http://xorg/", "no scheme.org/", "", None, "http://org/es/", "a://b://c.org/x", "http://.org/",
    "http://example.org.evil.com/de/1", "http://example.org/en/1#f/es/", "http://u@b.com:80/de/1", "HTTP://É.Com/DE/", "http://a..org//", "x://", "http://?/org/",
]
MORE = [*RULES, ("block", "a.org"), ("allow", "a.org/"), ("block", "a.org/"), ("block", "Sub.Example.org/en/"), ("allow", "example.org/en/17"), ("block", "")]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for verdict, rule in rules:
        h, p = url_filter.split_rule(rule)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h + p), len(h), verdict, h + p))
    return host, path, *((best[3], best[2]) if best else (None, "allow"))


def test_trie_and_join_equal_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate([*URLS, *URLS])), "page_id long, url string")
    for rules in (RULES, MORE):
        want = sorted([(i, u, *plain(u, rules)) for i, u in enumerate([*URLS, *URLS])], key=str)
        clash = pages.withColumn("HOST", F.lit(1))
        for out in (url_filter.judged(clash, rules), url_filter.matched_by_join(clash, spark.createDataFrame(rules, "verdict string, rule string"))):
            assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
            assert sorted([tuple(r) for r in out.collect()], key=str) == want


def test_large_rule_sets_are_joined(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_RULE_BYTES", 10)
    pages = spark.createDataFrame([(1, "http://b.com/de/1")], "page_id long, url string")
    out = url_filter.judged(pages, RULES)
    assert out.first()["verdict"] == "block"
    assert "Python" not in out._jdf.queryExecution().toString()


def test_empty_table(spark):
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []


def test_every_order_of_rules_gives_the_same():
    for rules in itertools.islice(itertools.permutations(MORE[5:9]), 24):
        trie = url_filter.build_trie(rules)
        assert url_filter.look_up(trie, "a.org", "/") == ("block", "a.org/")
