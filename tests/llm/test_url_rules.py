import random
import re

import pytest

from dealreports.llm import url_rules
from dealreports.llm.queries import URL_RULES


def split(url):
    after = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    return re.sub("[A-Z]", lambda c: c[0].lower(), host), path


def brute(pages, rules, default="allow"):
    out = []
    for page_id, url in pages:
        host, path = split(url)
        fit = [
            (len(h + p), len(h), h + p, v) for h, p, v in rules
            if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fit, default=(0, 0, None, default))
        out.append((page_id, host, path, *best[2:]))
    return sorted(out, key=str)


@pytest.fixture
def run(spark, clashing):
    def go(pages, rules):
        table = clashing(spark.createDataFrame(pages, "page_id long, url string"))
        rule_table = spark.createDataFrame(rules, "host string, path string, verdict string")
        out = url_rules.judged(table, rule_table)
        assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
        return sorted(map(tuple, out.collect()), key=str)

    return go


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "http://COM/x", "https://www.Example.com/en/1?q#f", "x://a://b.com/",
    "http://example.com/en/", "http://example.com/en", "http://example.com/de/", "http://notexample.com/en/", "http://example.com.evil.org/en/",
    "http://a.b.www.example.com/en/x", "http://net/es/", "http://x.net/fr/", "http://x.net/frx", "http://x.net?/fr/", "http://x.net#/fr/",
    "http://.com/", "http://example..com/", "http://com./", "http://exämple.com/en/ü", "http://user@example.com:80/en/", "http://net/es/\n/x",
]


def test_the_given_rules(run):
    pages = list(enumerate(URLS)) + [(3, URLS[7]), (3, URLS[7]), (None, URLS[8])]
    assert run(pages, URL_RULES) == brute(pages, URL_RULES)


@pytest.mark.parametrize(("events", "rows"), [(1000, 20_000), (4, 7), (2, 1)])
def test_many_nested_rules(run, monkeypatch, events, rows):
    monkeypatch.setattr(url_rules, "RANGE_EVENTS", events)
    monkeypatch.setattr(url_rules, "BUCKET_ROWS", rows)
    rng = random.Random(events)
    label = lambda: rng.choice(["a", "b", "ab", "com"])
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 4)))
    path = lambda: "".join(rng.choice(["/", "a", "/a", "b"]) for _ in range(rng.randrange(0, 4)))
    rules = {(host(), rng.choice(["", "/" + path()])): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(*k, v) for k, v in rules.items()] + [(None, "/", "block"), ("a", None, "block")]
    pages = [(i, f"http://{host()}/{path()}") for i in range(150)]
    assert run(pages, rules) == brute(pages, rules)


def test_repeated_rules_and_no_rows(run):
    pages = [(1, "http://a.com/x")]
    assert run(pages, [("com", "/", "allow"), ("com", "/", "block"), ("com", "/", "allow")]) == [(1, "a.com", "/x", "com/", "block")]
    assert run(pages, []) == [(1, "a.com", "/x", None, "allow")]
    assert run([], URL_RULES) == []


def test_a_hot_and_a_long_url(run):
    pages = [(i, "http://x.example.com/en/hot") for i in range(500)] + [(1000, "http://" + "a." * 2000 + "com/" + "y" * 50_000)]
    assert run(pages, URL_RULES) == brute(pages, URL_RULES)


def test_hosts_of_many_labels(run):
    """Looked up with no more endings than rules have labels: 100,000 labels would be 20 GB of keys."""
    hosts = ["a." * 100_000 + "example.com", "com." * 50_000 + "net", "www.example.com", "b"]
    pages = [(i, f"http://{h}/en/x") for i, h in enumerate(hosts)]
    assert run(pages, URL_RULES) == brute(pages, URL_RULES)


def test_only_built_in_functions(spark, sf_dir):
    from dealreports.llm.queries import QUERIES

    plan = QUERIES["op8_url_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|CartesianProduct|ExistingRDD", plan)
