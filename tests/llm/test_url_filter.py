import random

import pytest

from almanac.llm import url_filter

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", None, default
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = []
    for rule_host, rule_path, verdict in rules:
        if not rule_host or verdict is None:
            continue
        rule_host, rule_path = rule_host.lower(), rule_path or ""
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rule = rule_host + rule_path
            fits.append((len(rule), len(rule_host), verdict == "block", rule, verdict))
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, default)


def judged(spark, urls, rules, **how):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = url_filter.judge(pages, spark.createDataFrame(rules, RULES), **how).collect()
    assert len(rows) == len(urls)
    return [(r.host, r.path, r.rule, r.verdict) for r in sorted(rows, key=lambda r: r.page_id)]


def random_cases(seed):
    rng = random.Random(seed)
    label = lambda: rng.choice(["a", "b", "com", "A", ""])
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: rng.choice(["", "/"]) + "/".join(rng.choice(["x", "yy", "", "X"]) for _ in range(rng.randint(0, 4)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(30)]
    tails = ["", "?q=/x", "#/x", "/?a#b"]
    urls = [rng.choice(["http://", "://", "x:/", "HTTP://u://"]) + host() + path() + rng.choice(tails) for _ in range(300)]
    return urls, rules


@pytest.mark.parametrize("how", [{}, {"broadcast_rules": 0}, {"default": "block"}])
def test_as_by_brute_force(spark, how):
    urls, rules = random_cases(len(how))
    default = how.get("default", "allow")
    assert judged(spark, urls, rules, **how) == [brute(u, rules, default) for u in urls]


def test_longest_rule_decides(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es", "block")]
    urls = [
        "http://Www.Example.com/en/1?q#f", "http://m.example.com/en/", "http://example.com/en", "http://example.com",
        "http://notexample.com/en/", "ftp://x.net/espresso/", "https://com/", "http://example.com?/en/", "http://com.net/es",
    ]
    got = judged(spark, urls, rules)
    assert [g[2:] for g in got] == [
        ("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow"), (None, "allow"),
        ("com/", "allow"), ("net/es", "block"), ("com/", "allow"), (None, "allow"), ("net/es", "block"),
    ]


def test_equal_digest_prefixes_are_not_enough(spark, monkeypatch):
    """With one digit of the digest, nearly all expressions meet; the whole digests tell them apart."""
    monkeypatch.setattr(url_filter, "SHORT", 1)
    urls, rules = random_cases(7)
    assert judged(spark, urls, rules) == [brute(u, rules) for u in urls]


def test_ties(spark):
    """Equally long rules: the longer host, then the blocking one."""
    rules = [("b.com", "/x", "allow"), ("com", "/x/y", "block"), ("q.org", "/", "allow"), ("q.org", "/", "block")]
    got = judged(spark, ["http://b.com/x/y", "http://q.org/"], rules)
    assert [g[2:] for g in got] == [("b.com/x", "allow"), ("q.org/", "block")]


def test_odd_rows_and_rules(spark):
    rules = [(None, "/", "block"), ("", "", "block"), ("a.com", None, "block"), ("b.com", "/", None), ("a.com", None, "block")]
    long = "http://" + "l." * 20_000 + "a.com" + "/p" * 50_000
    urls = [None, "", "a.com/", "http://a.com", "http://b.com/", long, long, "http:///p", "://a.com\n"]
    got = judged(spark, urls, rules)
    assert got == [brute(u, rules) for u in urls]
    assert judged(spark, urls, []) == [brute(u, []) for u in urls]


def test_clashing_names_repeated_rows_and_empty_table(spark):
    columns = "page_id long, url string, host int, Path string, verdict string, best string, salt int, digest string, short string"
    row = (1, "http://a.com/x", 5, "p", "v", "b", 3, "d", "s")
    pages = spark.createDataFrame([row, row, (None,) * 9], columns)
    rules = spark.createDataFrame([("a.com", "/", "block")], RULES)
    got = url_filter.judge(pages, rules)
    assert got.columns == ["page_id", "url", "best", "salt", "digest", "short", "host", "path", "rule", "verdict"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted(
        [(1, row[1], "b", 3, "d", "s", "a.com", "/x", "a.com/", "block")] * 2 + [(None,) * 6 + ("", "", None, "allow")], key=str
    )
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    plan = url_filter.judge(pages, spark.createDataFrame([("a.com", "/", "block")], RULES))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
