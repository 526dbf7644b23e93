"""URL filter rules indexed by their rarest literal token (operator 6).

Two kinds of rules share one index:

* site rules ``host/path``: fit the host and its subdomains if the URL's path
  starts with the rule's path; of those that fit, the longest decides;
* pattern rules: regular expressions searched in ``host + path``; where no
  site rule fits, the longest matching pattern decides, and a URL that none
  matches is allowed.

A rule's literal tokens are runs of letters and digits that every URL it fits
contains whole; they are derived from its expression (``literal_tokens``).
Where an expression has choices ("casinos?"), a URL contains one of several
tokens: a slot. The rules' tokens are counted over all URLs (one distributed
aggregation, which no other token reaches), and each rule is filed under the
tokens of its slot that the fewest URLs have. A URL looks up its own tokens,
and only the rules filed under one of them run their regular expression; a
rule without a whole token is tried on every URL.

Rules are applied in blocks of bounded size, each broadcast and matched in
one pass over the URLs that keeps the best rule so far, so any number of
rules works without a shuffle of the URLs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.operators.joins import small_side

BLOCK_RULES = 50_000
TOKEN = re.compile(r"[0-9A-Za-z]+")


@dataclass(frozen=True)
class UrlRule:
    """``name`` is reported; ``pattern`` is searched in ``host + path``."""

    name: str
    verdict: str
    pattern: str
    site: bool = False

    @property
    def slots(self) -> list[frozenset[str]]:
        """Of each of these sets, a fitting URL has one token at least."""
        return literal_tokens(self.pattern)


#: A character that is no part of a token, and one that may be.
_EDGE, _ANY = "\x00", "\x01"
_MOST_TEXTS = 64


@lru_cache(maxsize=None)
def literal_tokens(pattern: str) -> list[frozenset[str]]:
    """Sets of tokens, of each of which every text that ``pattern`` fits contains one whole.

    The parsed expression is read from left to right as the texts it can
    stand for; what isn't a literal, a choice or an optional part is either an
    edge (only characters outside tokens) or anything. A token counts if it is
    bounded by edges; a stretch with more than 64 texts is cut.
    """
    parsed = re._parser.parse(pattern)
    if parsed.state.flags & re.IGNORECASE:
        return []
    out = []
    for stretch in _texts(parsed):
        found = [re.findall(rf"(?<![0-9A-Za-z{_ANY}])[0-9A-Za-z]+(?![0-9A-Za-z{_ANY}])", t) for t in stretch]
        if found and all(found):
            # every text has a token: one slot of each text's longest
            out.append(frozenset(max(x, key=lambda t: (len(t), t)) for x in found))
            out += [frozenset([t]) for t in sorted(set(found[0]).intersection(*found[1:]))]       # and the tokens of all of them
    return list(dict.fromkeys(out))


def _texts(parsed) -> list[list[str]]:
    """Stretches of an expression, each as the texts it can stand for; what lies between two stretches may be anything."""
    out, now = [], [_ANY]
    for item in parsed:
        part = _part(*item)
        if len(now) * len(part) > _MOST_TEXTS:
            out.append([t + _ANY for t in now])
            now = [_ANY]
        now = list(dict.fromkeys(t + x for t in now for x in part))
    out.append([t + _ANY for t in now])
    return out


def _part(op, value) -> list[str]:
    """The texts that one item of a parsed expression can stand for, "anything" among them."""
    op = str(op)
    if op == "LITERAL":
        c = chr(value)
        return [c if TOKEN.fullmatch(c) else _EDGE]
    if op == "AT":
        return [_EDGE] if str(value) in ("AT_BEGINNING", "AT_BEGINNING_STRING", "AT_END_STRING", "AT_END") else [""]
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in value):
        return sorted({chr(v) if TOKEN.fullmatch(chr(v)) else _EDGE for _, v in value})
    if op == "BRANCH":
        return sorted({t for x in value[1] for t in _whole(x)})
    if op == "SUBPATTERN" and not value[1] and not value[2]:
        return _whole(value[3])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, once = value[0], value[1], _whole(value[2])
        many = [] if most == 1 else [a + _ANY + b for a in once for b in once]
        found = [*([""] if least == 0 else []), *once, *many]
        return sorted(set(found)) if len(found) <= _MOST_TEXTS else [_ANY]
    return [_ANY]


def _whole(parsed) -> list[str]:
    """The texts of a part of an expression; just "anything" if they are too many."""
    out = [""]
    for item in parsed:
        part = _part(*item)
        if len(out) * len(part) > _MOST_TEXTS:
            return [_ANY]
        out = [t + x for t in out for x in part]
    return out


def site_rule(verdict: str, rule: str) -> UrlRule:
    """``host/path`` with a lower-case host; the path is a prefix."""
    host, path = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
    return UrlRule(rule, verdict, rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}", True)


#: Fixed by the contract.
SITE_RULES = [
    site_rule("allow", "com/"),
    site_rule("block", "example.com/en/"),
    site_rule("allow", "www.example.com/en/"),
    site_rule("block", "net/es/"),
    site_rule("block", "net/fr/"),
]

#: Words of hosts and paths that promise no text worth keeping, by subject.
TOPICS = {
    "gambling": "casino poker roulette blackjack jackpot slots betting sportsbook bookmaker lottery bingo",
    "pharmacy": "viagra cialis levitra tramadol xanax phentermine pharmacy pills steroids",
    "adult": "porn xxx hentai escort camgirl webcam nude fetish",
    "spam": "spam-farm cheap-pills link-farm payday-loan free-iphone replica-watch essay-writing get-rich fake-id work-from-home",
    "pirated": "torrent warez keygen crack nulled serial-key",
}
#: Hosts that serve adverts and counters, as labels of the host.
SERVERS = "adserver ads adservice doubleclick adsystem banner-ads pixel tracker tracking analytics telemetry clickserve popunder affiliate".split()
#: Pages that hold no article, as a whole part of the path.
PAGE_TYPES = ("login logout signin signup register password-reset cart checkout basket wishlist account my-account admin wp-admin wp-login cgi-bin "
              "search print sitemap calendar feed rss share subscribe unsubscribe captcha").split()
ENDINGS = ["html", "htm", "php", "asp", "aspx", "jsp"]


def _pattern_rules() -> list[UrlRule]:
    """The rules that the lists above stand for: every word as a host's label, as a part of the path, and with its plural."""
    out = []
    for topic, words in TOPICS.items():
        for w in words.split():
            out.append(UrlRule(f"{topic} host {w}", "block", rf"^(?:[^/]*[.-])?{w}s?(?:[.-]|$|/)"))
            out.append(UrlRule(f"{topic} path {w}", "block", rf"/(?:[^/]*[._-])?{w}s?(?:[./_-]|$)"))
    out += [UrlRule(f"server {w}", "block", rf"^(?:[^/]*\.)?{w}[.]") for w in SERVERS]
    for w in PAGE_TYPES:
        out.append(UrlRule(f"page {w}", "block", rf"^[^/]*/(?:[^/]+/)*{w}/?$"))
        out += [UrlRule(f"page {w}.{e}", "block", rf"/{w}\.{e}$") for e in ENDINGS]
    return out


#: Hosts and paths that are blocked where no site rule decides.
PATTERN_RULES = _pattern_rules()


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def token_counts(urls: DataFrame, tokens: Iterable[str]) -> dict[str, int]:
    """How many rows of ``urls`` (``host``, ``path``) hold each of ``tokens``; other tokens go before the shuffle, and the answer is as large as the rules."""
    wanted = sorted(set(tokens))
    if not wanted:
        return {}
    names = small_side(urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string"))
    own = F.array_distinct(F.regexp_extract_all(F.concat("host", "path"), F.lit(TOKEN.pattern), F.lit(0)))
    rows = urls.select(F.explode(own).alias("token")).join(names, "token", "left_semi").groupBy("token").count()
    return {r.token: r["count"] for r in rows.collect()}


class RuleIndex:
    """Compiled rules, filed by their rarest token."""

    def __init__(self, rules: list[UrlRule], counts: dict[str, int]):
        self.by_token: dict[str, list] = {}
        self.always: list = []
        for r in rules:
            entry = (r.site, len(r.name), r.name, r.verdict, re.compile(r.pattern))
            # the slot that the fewest URLs reach; of equal ones the longest words
            slot = min(r.slots, key=lambda s: (sum(counts.get(t, 0) for t in s), -min(map(len, s)), sorted(s)), default=())
            for token in slot:
                self.by_token.setdefault(token, []).append(entry)
            if not slot:
                self.always.append(entry)

    def candidates(self, text: str) -> list:
        found = {x[:4]: x for x in self.always}
        for token in set(TOKEN.findall(text)):
            found.update((x[:4], x) for x in self.by_token.get(token, ()))
        return list(found.values())

    def best(self, text: str) -> tuple | None:
        """``(site, length, name, verdict)`` of the rule that decides: a site rule before patterns, then the longest, then by name."""
        fits = [x[:4] for x in self.candidates(text) if x[4].search(text)]
        return max(fits, default=None)


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: list[UrlRule] | None = None,
               block_rules: int = BLOCK_RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, matched_by.

    ``rule`` is the site rule that decides (null: none), ``verdict`` its
    ``allow`` or ``block``, or else the pattern rules' (``allow`` where none
    matches); ``matched_by`` names whatever rule decided. Null URLs and URLs
    without ``://`` have an empty host and path and are allowed. Repeated
    rows give repeated rows; other columns are ignored.
    """
    rules = [*SITE_RULES, *PATTERN_RULES] if rules is None else rules
    urls = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    counts = token_counts(urls, (t for r in rules for s in r.slots for t in s))
    best = "struct<site:boolean,size:int,name:string,verdict:string>"
    out = urls.withColumn("best", F.lit(None).cast(best))
    for lo in range(0, len(rules), block_rules):
        block = pages.sparkSession.sparkContext.broadcast((rules[lo:lo + block_rules], counts))

        def match(batches, block=block):
            import pyarrow as pa

            index = RuleIndex(*block.value)
            for b in batches:
                old = b.column(3)
                new = []
                for host, path, had in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), old.to_pylist()):
                    got = index.best(host + path)
                    had = had and (had["site"], had["size"], had["name"], had["verdict"])
                    new.append(max((x for x in (had, got) if x), default=None))
                made = pa.array([x and dict(zip(("site", "size", "name", "verdict"), x)) for x in new], old.type)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], made], ["page_id", "host", "path", "best"])

        out = out.mapInArrow(match, out.schema)
    return out.select("page_id", "host", "path", F.when(F.col("best.site"), F.col("best.name")).alias("rule"),
                      F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), F.col("best.name").alias("matched_by"))
