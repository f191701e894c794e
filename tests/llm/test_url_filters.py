"""URL rules against plain Python, with rules of many shapes."""

import random

from barlake.llm.url_filters import judge_urls


def split(url):
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    cut = min([k for k, c in enumerate(rest) if c in "/?#"], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([k for k, c in enumerate(path) if c in "?#"], default=len(path))]


def brute(url, rules, default="allow"):
    host, path = split(url)
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[2:]) if fits else (host, path, None, default)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.example.net", "", "block"), ("com", "/d", "allow"), ("b.net", "/x", "block"), ("b.net", "/x", "allow")]


def test_equals_plain_python(spark):
    rnd = random.Random(1)
    hosts = ["example.net", "EXAMPLE.net", "a.example.net", "z.a.example.net", "xexample.net", "net", "b.net", "c.org", "example.com", "com.", "", "é.org"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/de/1", "/d", "/fr/?q", "/fr", "/x", "/x/y#z", "?/en/", "#/en/", "/é/ü"]
    urls = [f"http://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no scheme/x", "://net/", "a://b.net/x://example.net/en/", "http://" + "q." * 3000 + "net/" + "p" * 50_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.row.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_repeated_rows_clashing_columns_empty_tables_and_no_rules(spark):
    kind = "page_id long, url string, rule int, best string, prefix string"
    pages = spark.createDataFrame([(1, "http://x.net/", 1, "b", "p")] * 2 + [(None, None, None, None, None)], kind)
    rules = spark.createDataFrame([("NET", None, "block"), (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = [(r.row.page_id, r.row.rule, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, "net", "block")] * 2 + [(None, None, None, "allow")], key=str)
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert judge_urls(pages.limit(0), rules).count() == 0
