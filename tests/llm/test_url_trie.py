import random

import pytest

from lexrev.llm.url_trie import Trie, host_and_path, judge, keep_allowed

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def brute(url, rules, default="allow"):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url[url.index("://") + 3:]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h.split(".")) if h else 0, len(p), v == "block", h + p) for h, p, v in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], (("block" if best[2] else "allow") if best else default)


URLS = ["http://a.net/", "http://a.net", "https://www.Example.NET/en/x?q=/de/", "http://example.net/en", "http://example.net/english/",
        "http://example.com/de/1", "http://EXAMPLE.com/de", "http://badexample.com/de/", "http://x.org/fr/#a", "http://x.org?/fr/",
        "ftp://net/", "net/", "", None, "://", "http://", "http:///path", "a://b://c.net/", "http://net./", "http://.net/",
        "http://example.net:80/en/", "http://user@example.com/de/", "http://ÄB.net/ö\nx", "http://" + "a." * 3000 + "net/" + "x/" * 3000]


def test_contract(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(df, rules).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(URLS)}


def test_random_rules_in_one_block_and_in_many(spark):
    rnd = random.Random(5)
    hosts = ["", "com", "a.com", "b.a.com", "org", "x.org", "com.org"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab/", "/a//", "a"]
    rules = [(rnd.choice(hosts), rnd.choice(paths), rnd.choice(["allow", "block"])) for _ in range(40)]
    urls = [f"http://{rnd.choice(hosts + ['c.b.a.com', 'acom'])}{rnd.choice(paths + ['/a/b/c', '/ab', '/a//b'])}" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame([*rules, ("com", "/", None), ("com", "/", "other")], "host string, path string, verdict string")
    expected = {i: brute(u, rules, "block") for i, u in enumerate(urls)}
    for block in (10_000, 7):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(df, table, default="block", block_rules=block).collect()}
        assert got == expected


def test_edges(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    schema = "page_id long, url string, host int, rule int, `a b` int, text string"
    rows = [(1, "http://a.net/", 1, 2, 3, "t"), (1, "http://a.net/", 1, 2, 3, "t"), (None, None, None, None, None, None), (2, "x://b.com/", 4, 5, 6, "")]
    df = spark.createDataFrame(rows, schema)
    assert sorted(map(str, judge(df, rules).collect())) == sorted(
        map(str, judge(df.select("page_id", "url"), rules).collect()))
    kept = keep_allowed(df, rules)
    assert kept.schema == df.schema and sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if r.url != "http://a.net/")
    assert judge(df.limit(0), rules).count() == 0
    assert {r.verdict for r in judge(df, rules.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("url", URLS)
def test_trie_alone(url):
    host, path, rule, _ = brute(url, RULES)
    assert host_and_path(url) == (host, path)
    found = Trie(RULES).find(host, path)
    assert (found and found[3]) == rule
