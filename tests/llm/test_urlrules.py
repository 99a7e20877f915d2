"""The sweep against a loop over all rules."""

from __future__ import annotations

import random

from cardsentry.llm import urlrules

RULES = [("com", "/"), ("example.com", "/en/"), ("www.example.com", "/en/"), ("net", "/es/"), ("net", "/fr/"), ("a.net", ""), ("", "/x")]


def _plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, path = rest[:end], rest[end:]
        path = path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def _check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", 0) for i, u in enumerate(urls)], "page_id long, url string, host string, key int")
    ruled = spark.createDataFrame(rules, "host string, path string, action string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge_urls(pages, ruled).collect()}
    live = [r for r in rules if None not in r]
    assert got == {i: _plain(u, live) for i, u in enumerate(urls)}


def test_random_urls(spark):
    rng = random.Random(2)
    labels = ["www", "a", "b", "example", "com", "net", "co", "com,x", "EXAMPLE", "é"]
    urls = [None, "", "no scheme", "://", "http://", "http:///p", "x://com", "http://a.b://c", "http://com/?q=/en/", "https://www.example.com/en/#/es/",
            "http://com./en/", "http://.com/", "ftp://u@example.com:8/en/x"]
    for _ in range(700):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
        urls.append(f"http{rng.choice(['', 's'])}://{host}{rng.choice(['', '/', '/en/', '/en', '/es/x', '/fr/', '/en/x?a=/fr/', '#/en/'])}")
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in RULES] + [("com", "/", "block"), (None, "/", "block"), ("com", None, "allow")]
    _check(spark, urls, rules)
    many = [(".".join(rng.choice(labels[:7]) for _ in range(rng.randint(1, 3))), "/" * rng.randint(0, 1) + rng.choice(["", "e", "en/", "x"]),
             rng.choice(["allow", "block"])) for _ in range(300)]
    _check(spark, urls, many)


def test_one_url_many_times(spark):
    _check(spark, ["http://hot.example.com/en/"] * 500 + ["http://cold.net/es/"], [("example.com", "/en/", "block"), ("net", "/es/", "block")])


def test_empty(spark):
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, action string")
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlrules.judge_urls(pages, rules).count() == 0
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert urlrules.judge_urls(some, rules.limit(0)).first().verdict == "allow"
