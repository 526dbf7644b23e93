"""Verdicts against trying every rule on every URL; rules are filed under their rarest token."""

import random
import re

from pyspark.sql import functions as F

from curata.llm import url_rules as U

URLS = [None, "", "no scheme", "http://", "https://a.com", "https://a.com/", "https://A.COM/x?y#z", "ftp://com/", "http://notcom/", "http://example.com/en/",
        "http://example.com/en", "http://www.example.com/en/1", "http://blog.www.example.com/en/1", "http://wwwexample.com/en/1", "http://m.example.com/en/x/y",
        "http://a.net/es/1", "http://a.net/es", "http://a.net/ES/1", "http://net/fr/", "http://a.net/de/", "http://spam-farm.example.org/en/1",
        "http://xspam-farm.example.org/", "http://spam-farm.a.com/x", "http://a.org/casino", "http://a.org/casinos/1", "http://a.org/xcasino", "http://a.org/login",
        "http://a.org/login.php?x", "http://a.org/loginx", "x://y.org/a://b.com/", "https://a.com:80/x", "https://a.com?x=/", "https://user@a.com/", "http://é.net/fr/ü",
        "http://a.net#x/es/", "https://b.example.com/en/" + "x/" * 20000, "http://a.com/\nen", "http://a.\n.com/"]


def brute(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    site = []
    for r in rules:
        if r.site:
            h, p = r.name.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                site.append((len(r.name), r.name, r.verdict))
    if site:
        return host, path, max(site)[1], max(site)[2]
    other = [(len(r.name), r.name, r.verdict) for r in rules if not r.site and re.search(r.pattern, host + path)]
    return host, path, None, max(other)[2] if other else "allow"


def test_verdicts(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[9]), (6, URLS[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(3)).withColumn("best", F.lit(1))
    want = sorted(((i, *brute(u, [*U.SITE_RULES, *U.PATTERN_RULES])) for i, u in rows), key=str)
    for block in (U.BLOCK_RULES, 150):
        got = U.judge_urls(pages, block_rules=block).drop("matched_by").collect()
        assert sorted(map(tuple, got), key=str) == want


def test_index_runs_few_rules():
    rules = [U.site_rule("block", f"site{i}.com/en/") for i in range(1000)]
    index = U.RuleIndex(rules, {"com": 10**6, "en": 10**5})
    assert len(index.candidates("www.site7.com/en/1")) == 1 and index.best("www.site7.com/en/1")[2] == "site7.com/en/"


def test_prefix_rule_token_may_go_on():
    rule = U.site_rule("block", "a.com/pre")
    assert set().union(*rule.slots) == {"a", "com"} and U.RuleIndex([rule], {}).best("a.com/prefix")


def test_tokens_come_from_the_expression():
    slots = lambda p: [set(s) for s in U.literal_tokens(p)]
    assert slots(r"/login(?:[./]|$)") == [{"login"}] and slots(r"/login") == [] and slots(r"login/") == []
    assert slots(r"(?:^|[./_-])casinos?(?:[./_-]|$)") == [{"casino", "casinos"}]
    assert slots(r"(?:^|[.])cheap-pills[.]") == [{"pills"}, {"cheap"}]
    assert slots(r"/(?:cat|dog)/(?:x/)?news/") == [{"news"}] and slots(r"/(?:cat|dog)/") == [{"cat", "dog"}]
    assert {frozenset(["example"]), frozenset(["com"]), frozenset(["en"])} == set(U.site_rule("block", "example.com/en/").slots)
    assert slots(r"/a+b/") == [] and slots(r"(?i)/login/") == [] and slots(r"^(?:[^/]*[.])?pills[.]") == [{"pills"}] and slots(r"^[^/]*pills[.]") == []


def test_index_finds_what_trying_every_rule_finds():
    """Texts made of the rules' own words, bounded in every way: the index gives what all rules tried give."""
    r = random.Random(9)
    rules = [*U.SITE_RULES, *U.PATTERN_RULES]
    assert len(U.PATTERN_RULES) > 200 and sum(not x.slots for x in rules) <= len(rules) // 100
    words = sorted({t for x in rules for s in x.slots for t in s}) + ["a", "blog", "example", "news"]
    counts = {w: r.randint(0, 1000) for w in words}
    index = U.RuleIndex(rules, counts)
    tried = []
    for _ in range(6000):
        text = "".join(r.choice(words) + r.choice(["", "s", ".", "-", "/", "/", "_", "."]) for _ in range(r.randint(1, 5))) + r.choice(["", ".html", "/", "x"])
        want = max(((x.site, len(x.name), x.name, x.verdict) for x in rules if re.search(x.pattern, text)), default=None)
        assert index.best(text) == want, text
        tried.append(len(index.candidates(text)))
    assert sum(tried) / len(tried) < len(rules) / 10


def test_clean_urls_are_allowed():
    index = U.RuleIndex(U.PATTERN_RULES, {})
    for url in ("www.example.com/en/history-of-france.html", "blog.example.org/2020/05/the-account-of-a-journey", "example.net/research/searching/1", "a.com/pilsner/beers",
                "adsorption.example.com/logins", "shares.org/x"):
        assert index.best(url) is None, url


def test_empty_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(none).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in U.judge_urls(one, rules=[]).collect()] == ["allow"]
