import re

import pytest

from quayside.llm import url_rules

URLS = [
    "https://example.org/es/1", "https://a.Example.ORG/es/", "http://example.org/es", "http://example.org/en/12", "http://badexample.org/en/1",
    "http://x.com/fr/", "http://x.com/FR/", "http://com/de/x", "http://x.com.evil.net/de/", "ftp://u:p@x.com:80/de/", "x.com/de/", None, "", "://", "https://",
    "https://x.org", "https://x.org?a=/", "https://x.org#/es/", "http://a.org/b://c.com/de/", "a?b://x.com/de/y", "http://blog.adult-x.example.net/en/3",
    "http://shop.net/cart/1", "http://shop.net/cartoon/1", "http://ads.org/ads/", "http://casino.com/fr/x", "z" * 20000 + "://x.com/de/" + "y" * 20000,
    "http://example.org/en/1", "http://example.org/en/1", "http://exam\nple.org/es/", "http://ÄÖ.org/x",
]
BASE = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def judged(url):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [(len(h + p), h + p, v) for h, p, v in BASE if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2], None
    own = [r for r in url_rules.UNLISTED if re.search(r.pattern, host + path)]
    best = min(own, key=lambda r: (-r.weight, r.name), default=None)
    return host, path, None, best.verdict if best else "allow", best.name if best else None


@pytest.mark.parametrize("most", [4 << 20, -1])
def test_against_all_rules_on_all_urls(spark, monkeypatch, most):
    monkeypatch.setattr(url_rules, "BROADCAST_BYTES", most)
    rows = [(i if i % 9 else None, u, "h", "x") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, token string")
    got = url_rules.url_verdicts(pages, [*url_rules.LISTED, *url_rules.UNLISTED]).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *judged(u))) for i, u, _, _ in rows)


def test_rules_are_filed_under_their_rarest_token():
    rule = url_rules.host_path_rule("example.org", "/en/1", "block")
    assert rule.tokens == ("example", "org", "en")  # the last may go on in a URL: /en/12


def test_rules_need_a_token(spark):
    with pytest.raises(ValueError, match="literal token"):
        url_rules.url_verdicts(spark.createDataFrame([(1, "x")], "page_id long, url string"), [url_rules.Rule("r", ".", (), "block", 1)])


def test_empty_table(spark):
    assert url_rules.url_verdicts(spark.createDataFrame([], "page_id long, url string"), url_rules.LISTED).collect() == []


def test_rules_pass_no_python_worker(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    judged = url_rules.url_verdicts(pages, [*url_rules.LISTED, *url_rules.UNLISTED])
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan


@pytest.mark.parametrize("n", [10_000])
def test_many_rules_meet_few_urls(spark, n):
    """Every rule has a common and a rare token; it is filed under the rare one, and only it is looked at."""
    rules = [url_rules.Rule(f"r{i}", rf"/shop/k{i}(/|$)", ("shop", f"k{i}"), "block", 1, False) for i in range(n)]
    rows = [(i, f"http://h{i % 7}.org/shop/k{i * 3}/x") for i in range(300)] + [(1000, "http://a.org/shop/"), (1001, None)]
    got = url_rules.url_verdicts(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    assert {r["page_id"]: r["pattern_rule"] for r in got} == {i: f"r{i * 3}" for i in range(300)} | {1000: None, 1001: None}
