import re

import pytest

from tickflow.llm.urls import RULES, SOFT, STRICT, judge

SCHEMA = "page_id long, url string, html string, host int, rule double"


def brute(url):
    url = url or ""
    scheme, sep, rest = url.partition("://")
    host = re.split(r"[/?#]", rest, maxsplit=1)[0] if sep else ""
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0] if sep else ""
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fit, key=lambda r: len(r.text), default=None)
    low = url.lower()
    found = lambda terms: sum(bool(re.search(rf"(?<![^\W_]){t}(?![^\W_])", low)) for t in terms)
    strict, soft = found(STRICT), found(SOFT)
    verdict = rule.verdict if rule else "block" if strict or soft >= 2 else "allow"
    return host, path, rule and rule.text, verdict, strict, soft


URLS = ["http://www.Example.COM/en/1", "http://example.com/en/", "http://example.com/en", "https://a.example.com/fr/x?y#z", "http://com", "http://com/",
        "http://x.net/es/1", "http://x.net/es", "http://x.net/fr/a", "http://xnet/es/1", "http://notexample.com/en/1", "https://spam-farm.example.org/en/685",
        "http://spamfarm.org/", "http://cheap.org/free", "http://cheap.org/cheaper", "http://a.org/free-free-free", "http://a.org/?q=casino", "http://a.org/casinos",
        "no scheme", "", None, "a://b://c/d", "http://x.net/ES/1", "http://ÄB.org/p\nq?x", "HTTP://WWW.CHEAP-PILLS.NET/de/2", "http:///path", "http://?q", "x" * 100_000 + "://com/",
        "http://u:p@h.com:80/en/", "http://xxx.org", "http://axxx.org/xxx_1", "http://a.org/éxxxé", "http://a.org/的casino", "http://a.org/é-xxx"]


@pytest.mark.parametrize("parts", [1, 4])
def test_equals_plain_reading(spark, parts):
    rows = [(k, u, None, 1, 2.0) for k, u in enumerate(URLS)] + [(None, "http://com/", None, None, None), (3, URLS[3], None, None, None)]
    got = judge(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(i, *brute(u)) for i, u, *_ in rows], key=repr)


def test_vocabulary_is_a_table_with_weights(spark):
    terms = spark.createDataFrame([("Foo", 100, 1), ("bar", 40, 1), ("baz", 30, 1), ("qux", 30, 1), ("bar", 10, 1), (None, 100, 1), ("", 100, 1), ("none", None, 1)],
                                  "term string, weight long, page_id int")
    urls = ["http://a.org/foo", "http://a.org/bar-baz", "http://a.org/bar-baz-qux", "http://a.org/foot", "http://a.org/none", "http://com/foo"]
    pages = spark.createDataFrame([(k, urls[k % 6], None, None, None) for k in range(6000)], SCHEMA)
    got = {(r.page_id % 6, r.verdict, r.strict_hits, r.soft_hits) for r in judge(pages, vocabulary=terms).collect()}
    assert got == {(0, "block", 1, 0), (1, "allow", 0, 2), (2, "block", 0, 3), (3, "allow", 0, 0), (4, "allow", 0, 0), (5, "allow", 1, 0)}
    assert {r.verdict for r in judge(pages, vocabulary=()).collect()} == {"allow"}


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], SCHEMA)).count() == 0
