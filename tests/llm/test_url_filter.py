from __future__ import annotations

import random

from pyspark.sql import functions as F

from windrow.llm import url_filter
from windrow.llm.registry import URL_RULES

RULES = "host string, path string, action string"


def brute(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fits = [
        (len(h + p), len(h), a == "block", h + p) for h, p, a in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], "block" if best and best[2] else "allow"


URLS = [
    None, "", "example.org/es/", "http://", "://", "http://example.org", "https://EXAMPLE.org/es/x?y=/en/1#z",
    "http://a.b.example.org/en/1", "http://example.org/en/12", "http://example.org/en/", "http://notexample.org/es/",
    "ftp://com/de/", "http://x.com/de/1", "http://x.com/DE/1", "http://x.com?/de/", "http://x.com#/de/",
    "a://b://c.org/", "http://ö.org/\nx", "http://org", "http://org/", "http://x..org/",
]


def verdicts(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    pages = pages.select("*", F.lit(1).alias("host"), F.lit(2).alias("rule"), F.lit(3).alias("key"))
    rows = url_filter.judge_urls(pages, spark.createDataFrame(rules, RULES)).collect()
    assert len(rows) == len(urls)
    return [tuple(r[1:]) for r in sorted(rows, key=lambda r: r[0])]


def test_urls_against_brute_force(spark):
    some = random.Random(0)
    hosts = ["org", "example.org", "a.example.org", "com", "x.com", "net"]
    paths = ["/", "/es/", "/en/1", "/fr/", "/de/2", ""]
    urls = URLS + [f"http://{some.choice(hosts)}{some.choice(paths)}{some.randint(0, 20)}" for _ in range(300)]
    urls += urls[:3]
    assert verdicts(spark, urls, URL_RULES) == [brute(u, URL_RULES) for u in urls]
    more = [(h, p, some.choice(["allow", "block"])) for h in hosts for p in paths if some.random() < 0.5]
    assert verdicts(spark, urls, more) == [brute(u, more) for u in urls]


def test_no_rules_no_pages_and_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id bigint, url string")
    rules = spark.createDataFrame(URL_RULES + [(None, "/", "block"), ("org", None, "allow"), ("x.org", "/", "allow"), ("x.org", "/", "block")], RULES)
    assert url_filter.judge_urls(pages, rules.limit(0)).first()["verdict"] == "allow"
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert url_filter.judge_urls(pages, rules).first()["verdict"] == "block"


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"))
    listed = universe.where("crc32(key) % 50 = 0").unionByName(spark.createDataFrame([("other",), (None,)], "key string"))
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    wrong = universe.where(cascade.lists(F.col("key")) != (F.crc32("key") % 50 == 0))
    assert wrong.count() == 0
