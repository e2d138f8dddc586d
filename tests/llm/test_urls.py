import random
import re

from tests.llm.cases import CLASHING
from tidemark.llm import urls
from tidemark.llm.queries import HOST_RULES, PATTERN_RULES
from tidemark.llm.urls import HostRule, PatternRule, index_rules, judge_urls

URLS = [None, "", "no scheme", "://", "http://COM/", "http://com", "http://x.com?a=1", "https://WWW.Example.COM/en/1#x",
        "https://a.example.com/en/1", "http://www.example.com/EN/1", "http://aexample.com/en/", "http://b.net/es/",
        "http://net/fr/x?y/../", "http://b.net/es", "a://b://c.com/x", "http://spam-farm.org/", "http://spam-farms.org/",
        "http://xspam-farm.org/", "http://a.org/?u=CHEAP-pills", "http://a.org/?utm_source=q&x=1&ref=2",
        "http://user@h.com:80/p", "http://a.org/login/", "http://a.org/xlogin/", "http://h.com/é\n/x", "http://" + "a" * 50_000 + ".com/"]


def brute(url):
    """Every rule is tried."""
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"(?s)[^/?#]*", rest)[0]
        path = re.match(r"(?s)[^?#]*", rest[len(host):])[0]
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    host = lower(host)
    fits = [r for r in HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    hits = [r for r in PATTERN_RULES if re.search(
        "(?s)" + ("" if "*" in (r.pattern[0], r.pattern[-1]) else "(?<![a-z0-9])")
        + ".*".join(map(re.escape, r.pattern.split("*")))
        + ("" if "*" in (r.pattern[0], r.pattern[-1]) else "(?![a-z0-9])"), lower(url or ""))]
    pattern = max(hits, key=lambda r: (len(r.pattern), r.pattern), default=None)
    verdict = best.action if best else pattern.action if pattern else "allow"
    return host, path, best and best.text, verdict, pattern and pattern.text


def frame(spark, some):
    from pyspark.sql import functions as F
    return spark.createDataFrame(list(enumerate(some)), "page_id long, url string").withColumns(
        {c: F.lit(1) for c in CLASHING})


def test_against_every_rule(spark, monkeypatch):
    r = random.Random(2)
    parts = ["www.", "m.", "example", "other", ".com", ".net", ".org", "/en/", "/es/", "/fr/", "?a=1", "#t", "spam-farm",
             "utm_source=", "&ref=", "X", "/login/", "casino-win"]
    some = URLS + ["http://" + "".join(r.choices(parts, k=r.randrange(1, 7))) for _ in range(400)]
    want = [(i, *brute(u)) for i, u in enumerate(some)]
    for most in (urls.RULES_A_PASS, 2):  # with 2, more rules than one pass takes
        monkeypatch.setattr(urls, "RULES_A_PASS", most)
        assert sorted(map(tuple, judge_urls(frame(spark, some), HOST_RULES, PATTERN_RULES).collect())) == want


def test_rules_are_filed_under_their_rarest_token():
    rules = [HostRule("block", "example.com", "/en/"), PatternRule("block", "*rest of-it*"), HostRule("block", "com", "/e")]
    index = index_rules(rules, {"example": 5, "com": 9, "en": 2})
    assert index["en"] == [rules[0]] and index["com"] == [rules[2]]
    assert rules[1] in index["of"]  # its other words may go on


def test_every_pattern_has_a_key():
    from dataclasses import replace
    for rule in PATTERN_RULES:
        assert rule.tokens and replace(rule, anywhere=True).tokens
    keys = lambda text, anywhere=False: PatternRule("block", text, anywhere).tokens
    assert keys("spam-farm") == {"spam", "farm"} and keys("spam-farm", True) == {">spam", "<farm"}
    assert keys("casino", True) == {"*casino"} and keys("*casino*") == {"*casino"} and keys("/x/", True) == {"x"}
    assert keys("a*b", True) == {"*a", "*b"} and keys("a*b") == {"<a", ">b"} and keys("*.*", True) == set()
    index = index_rules([PatternRule("block", "farm-casino", True)], {">farm": 3, "<casino": 2})
    assert list(index) == ["<casino"]


def test_parts_of_tokens_fetch_the_same_rules(spark, monkeypatch):
    r = random.Random(5)
    bits = ["ab", "b", "abc", "a", "1", "-", "/", ".", "*", "=", "ca"]
    texts = sorted({"".join(r.choices(bits, k=r.randrange(1, 5))) for _ in range(150)} - {"*"})
    rules = [PatternRule(r.choice(["allow", "block"]), t) for t in texts]
    some = [None, "", "*", "<ab", *("".join(r.choices([b for b in bits if b != "*"], k=r.randrange(1, 9))) for _ in range(300))]
    for plain in (False, True):
        rank = lambda p: (len(p.text), p.action == "block")
        want = []
        for u in some:
            hits = [p for p in rules if re.search("(?s)" + ".*".join(map(re.escape, p.text.split("*"))) if plain or "*" in (
                p.text[0], p.text[-1]) else "(?s)(?<![a-z0-9])" + ".*".join(map(re.escape, p.text.split("*"))) + "(?![a-z0-9])",
                u or "")]
            top = max(map(rank, hits), default=None)
            texts = sorted(p.text for p in hits if rank(p) == top)
            want.append(texts and (texts[0] if plain else texts[-1]) or None)
        for most in (urls.RULES_A_PASS, 40):
            monkeypatch.setattr(urls, "RULES_A_PASS", most)
            got = judge_urls(frame(spark, some), [], rules, plain=plain).orderBy("page_id").collect()
            assert [row["pattern"] for row in got] == want


def test_counts_of_token_parts(spark):
    some = ["http://spamfarm.org/spam", "ab-abab", "", None, "SPAM", "xspam yspam"]
    counts = urls.token_counts(frame(spark, some), "url", {"spam", ">spam", "<spam", "*ba", "*am", "<abc", "none"})
    assert counts == {"spam": 2, ">spam": 3, "<spam": 2, "*ba": 1, "*am": 3}


def test_no_rows_and_no_rules(spark):
    assert judge_urls(frame(spark, ["x"]).limit(0), HOST_RULES, PATTERN_RULES).count() == 0
    assert [r.verdict for r in judge_urls(frame(spark, URLS), [], []).collect()] == ["allow"] * len(URLS)


#: By hand: verdict and pattern of the registered query.
BY_HAND = {"http://a.org/login/x": ("block", "/login/"), "https://example.org/login/": ("block", "/login/"),
           "https://example.org/wp-admin/x.php": ("block", "/wp-admin/"), "http://a.org/xlogin/": ("allow", None),
           "http://a.org/login": ("allow", None), "http://spam-farms.org/": ("block", "spam-farm"),
           "http://myspam-farm.com/": ("allow", "spam-farm"), "http://casino-win.org/wp-admin/": ("block", "/wp-admin/"),
           "http://a.org/?xutm_source=1&ref=2": ("block", "utm_source=*&ref=*"), "http://a.org/?utm_sources=1&ref=2": ("allow", None)}


def test_registered_query_finds_patterns_without_borders(spark, tmp_path, monkeypatch):
    import duckdb
    from tidemark.llm.queries import ORACLE, op2_url_filter
    some = [*BY_HAND, *URLS]
    frame(spark, some).select("page_id", "url").write.parquet(f"{tmp_path}/pages.parquet")
    want = duckdb.sql(f"WITH pages AS (FROM '{tmp_path}/pages.parquet/*.parquet') SELECT * FROM ({ORACLE['op2_url_filter']})")
    want = sorted(want.fetchall())
    for most in (urls.RULES_A_PASS, 2):
        monkeypatch.setattr(urls, "RULES_A_PASS", most)
        got = sorted(map(tuple, op2_url_filter(spark, str(tmp_path)).collect()))
        assert [(r[4], r[5]) for r in got[:len(BY_HAND)]] == list(BY_HAND.values())
        assert got == want
