"""URL rules against running every rule on every URL."""

import re

import pytest

from velotide.llm import urls
from velotide.llm.urls import Rule

URLS = [
    None,
    "",
    "no scheme/com/",
    "http://",
    "HTTP://WWW.Example.COM/en/x?q=1#f",
    "http://www.example.com/en/",
    "http://example.com/en/x",
    "http://a.b.example.com/en/x",
    "http://badexample.com/en/x",
    "http://example.com",
    "http://example.com?x=/en/",
    "http://x.net/es/1",
    "http://x.net/ES/1",
    "http://net/fr/",
    "http://x.org/a://b/c",
    "http://x.org/casino",
    "http://x.org/casinos",
    "http://x.org/dl/setup.exe?v=2",
    "http://x.org/dl/setup.exec",
    "http://ads-1.x.org/p",
    "http://é.org/login/ü\nnet/es/",
    "://host/path",
    "http://x.org:80/wp-login.php",
    "http://x\na.example.com/en/q",
    "http://x.net\n/es/1",
    "http://\nexample.com/en/",
    "http://x.com\r\n/en/",
    "http://example.com\n/en/",
]


def brute(url, given=urls.GIVEN, patterns=urls.PATTERNS):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [
        r
        for r in given
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if fit:
        best = max(fit, key=lambda r: len(r.text))
        return host, path, best.text, best.action
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    block = any(re.search(r.regex, low) for r in patterns)
    return host, path, None, "block" if block else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i if i % 5 else None, u, "h", 1) for i, u in enumerate(URLS + URLS[:3])]
    return spark.createDataFrame(rows, "page_id long, url string, verdict string, candidates int")


def test_equals_all_rules_on_all_urls(pages):
    got = sorted(repr((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])) for r in urls.judge(pages).collect())
    want = sorted(repr((p, *brute(u))) for p, u, *_ in pages.collect())
    assert got == want


def test_equals_all_rules_by_table(pages, monkeypatch):
    monkeypatch.setattr(urls, "PLAN_RULES", 0)
    got = sorted(repr((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])) for r in urls.judge(pages).collect())
    assert got == sorted(repr((p, *brute(u))) for p, u, *_ in pages.collect())
    bare = [Rule("ads", "block", by_host=False), Rule("e*/e", "block", by_host=False)]  # without a sure token
    got = {(r["host"], r["verdict"]) for r in urls.judge(pages, patterns=bare).collect()}
    assert got == {(b[0], b[3]) for b in (brute(u, patterns=bare) for u in URLS)}


def test_very_many_rules(spark):
    """100,000 rules; each URL meets few of them."""
    given = [Rule(f"host{i % 30_000}.{('com', 'org')[i % 2]}/p{i // 30_000}/", ("allow", "block")[i % 3 == 0]) for i in range(90_000)]
    patterns = [Rule(f"/tag{i}^", "block", by_host=False) for i in range(10_000)]
    links = [f"https://{'www.' * (i % 2)}host{i * 7 % 31_000}.com/p{i % 4}/tag{i * 3 % 12_000}/x" for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(links)), "page_id long, url string")
    rows = urls.judge(docs, given, patterns).collect()
    by_text, by_tag = {r.text: r for r in given}, {f"tag{i}" for i in range(10_000)}
    for r in rows:
        first, second = r["path"].split("/")[1:3]
        rule = by_text.get(f"{r['host'].removeprefix('www.')}/{first}/")
        want = rule.action if rule else "block" if second in by_tag else "allow"
        assert (r["rule"], r["verdict"]) == (rule and rule.text, want)
    assert len(rows) == 2000 and len({r["verdict"] for r in rows}) == 2
    assert max(r["n_candidates"] for r in rows) <= 5


def test_only_candidates_run(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = urls.judge(pages).collect()
    everything = len(urls.GIVEN) + len(urls.PATTERNS)
    assert max(r["n_candidates"] for r in rows) < everything / 2
    texts = {r["page_id"]: r["url"] for r in pages.collect()}
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(texts[r["page_id"]])


def test_sure_tokens():
    assert Rule("/ads-", "block", False).tokens() == ["ads"]
    assert Rule("ads", "block", False).tokens() == []
    assert Rule("*.exe^", "block", False).tokens() == ["exe"]
    assert Rule("/a*b.c", "block", False).tokens() == []
    assert Rule("example.com/en/x", "block").tokens() == ["com", "en", "example"]


def test_rarest_token_is_the_key():
    rules = [Rule("example.com/en/", "block"), Rule("x*", "block", False)]
    assert urls.index(rules, {"example": 9, "com": 90, "en": 3}) == {"en": [0], "": [1]}


def test_a_rule_without_a_sure_token_still_runs(spark):
    pages = spark.createDataFrame([(1, "http://h/abads2", "")], "page_id long, url string, html string")
    row = urls.judge(pages, given=[], patterns=[Rule("ads", "block", by_host=False)]).first()
    assert row["verdict"] == "block"
