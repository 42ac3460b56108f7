"""URL rules against a plain matcher."""

from __future__ import annotations

import random
import re

import pytest

from plumbline.llm import url_rules


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h), len(p or ""), h + (p or ""), v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("broadcast_rules", [1000, 0])
def test_random_urls(spark, broadcast_rules):
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "bb", "example", "net", "org", "x-y"])
    rules = {(".".join(label() for _ in range(rng.randrange(1, 4))), rng.choice(["/", "/en/", "/e", "/en/x", "", None])): rng.choice(["block", "allow"])
             for _ in range(40)}
    rules = [(h, p, v) for (h, p), v in rules.items() if not (p == "" and (h, None) in rules)]
    urls = [f"http{rng.choice(['', 's'])}://{'.'.join(label() for _ in range(rng.randrange(1, 6))).title()}"
            f"{rng.choice(['', '/', '/en/', '/en/x?y=/', '/fr/#z', '?a=b://c', '#/en/', '/en'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "http://", "a://b.net://c", "ftp://" + "s." * 500 + "net/" + "p" * 100_000, "http://ne\nt/x\ny"]
    df = spark.createDataFrame([(i, u, "r", "h") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("", "/", "block")], url_rules.SCHEMA)
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(df, table, broadcast_rules=broadcast_rules).collect()}
    assert rows == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_precedence_and_edges(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")], url_rules.SCHEMA)
    df = spark.createDataFrame([(1, "http://a.EXAMPLE.net/en/1"), (1, "http://a.EXAMPLE.net/en/1"), (2, "http://example.net/EN/"),
                                (3, "http://example.net"), (None, "http://notexample.com/de/"), (5, "http://m.example.com/de/x")], "page_id long, url string")
    rows = sorted(((r.page_id, r.rule, r.verdict) for r in url_rules.judge(df, rules).collect()), key=str)
    assert rows == sorted([(1, "example.net/en/", "allow")] * 2 + [(2, "net/", "block"), (3, None, "allow"), (None, None, "allow"),
                                                                    (5, "example.com/de/", "block")], key=str)
    assert url_rules.judge(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_rules.judge(df, rules.limit(0), default="block").collect()} == {"block"}
