"""Filter lists: tokens read off expressions, and verdicts equal to running every rule."""

import random
import re

import pytest

from tidemark.llm import url_rules
from tidemark.llm.url_rules import filter_rule, filter_rules, sure_tokens

WORDS = ["ads", "track", "shop", "news", "img", "banner", "pixel", "a1", "x", "cdn", "de", "promo"]


@pytest.mark.parametrize("pattern, tokens", [
    (r"^(?:[^/]*[.-])?casino[.-]", ("casino",)),
    (r"^(?:[^/]*[.-])?(?:free|best|live)-bets[.-]", ("bets",)),
    (r"/xxx(?:/|$)", ("xxx",)),
    (r"/ads", ()),              # /adserver matches too
    (r"ads/", ()),
    (r"/ads_new/", ("ads", "new")),
    (r"/a-*b/", ()),
    (r"/(?:-x)?ab/", ()),
    (r"-(?:x-)?ab/", ("ab",)),
    (r"/(?:ab/)+cd/", ("cd",)),
    (r"/ab{2}/", ()),
    (r"(?i)/ads/", ()),
    (r"/[a-z]ds/-ok-", ("ok",)),
    (r"[.\-/]ok[^\w]", ("ok",)),
    (r"\bok\b", ("ok",)),
    (r"/ab(?=/)", ()),
    (r"", ()),
])
def test_sure_tokens(pattern, tokens):
    assert sure_tokens(pattern) == tokens


def test_lines():
    assert [filter_rule(line) for line in ("", "! remark", "[Heading]", "site.org##.ad")] == [None] * 4
    rule = filter_rule("@@||shop.example.com^news/*.gif|")
    assert rule.verdict == "allow" and rule.tokens == ("shop", "example", "com", "news", "gif")
    for target, hit in (("shop.example.com/news/a.gif", True), ("www.shop.example.com/news/.gif", True), ("myshop.example.com/news/a.gif", False)):
        assert bool(re.search(rule.pattern, target)) == hit
    assert filter_rule("/^x[0-9]+/").pattern == "^x[0-9]+"
    with pytest.raises(ValueError):
        filter_rule("||a.com^$third-party")


def _lines(draw):
    def word():
        return draw.choice(WORDS)
    kinds = [
        lambda: f"||{word()}.{word()}^", lambda: f"/{word()}/*{word()}", lambda: f"-{word()}-", lambda: f"^{word()}^",
        lambda: f"|{word()}.", lambda: f"{word()}.gif|", lambda: f"/(?:{word()}|{word()})[-./]{word()}(?:/|$)/", lambda: f"/[./]{word()}[0-9]*[./]/",
        lambda: f"{word()}*{word()}^",
    ]
    return [draw.choice(["", "", "@@"]) + draw.choice(kinds)() for _ in range(400)]


def test_verdicts_equal_running_every_rule(spark):
    draw = random.Random(3)
    rules = url_rules.HOST_RULES + filter_rules(_lines(draw))
    assert len(rules) > 300 and sum(not r.tokens for r in rules) < len(rules) / 2
    urls = [None, "", "no scheme", "http://", "http://example.net/en/x"]
    for _ in range(3000):
        host = ".".join(draw.choice(WORDS) + draw.choice(["", "", "-b", "7"]) for _ in range(draw.randint(1, 3)))
        path = "".join(draw.choice("/-_.") + draw.choice(WORDS) + draw.choice(["", "", "9", "X"]) for _ in range(draw.randint(0, 4)))
        urls.append(f"http://{host}{path}{draw.choice(['', '.gif', '/', '?q=ads'])}")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    seen = set()
    for row in url_rules.judged(pages, rules).collect():
        target, best, patterns = row["host"] + row["path"], None, set()
        for rule in rules if row["host"] else ():
            if re.search(rule.pattern, target):
                if rule.name is None:
                    patterns.add(rule.verdict)
                elif best is None or len(rule.name) > len(best.name):
                    best = rule
        plain = (best.name, best.verdict) if best else (None, "block" if patterns == {"block"} else "allow")
        assert (row["rule"], row["verdict"]) == plain, target
        seen.add(plain)
    assert {(None, "block"), (None, "allow")} < seen


def test_empty_table_and_repeated_rows(spark):
    assert url_rules.judged(spark.createDataFrame([], "page_id long, url string")).count() == 0
    twice = spark.createDataFrame([(1, "http://casino.de/")] * 2, "page_id long, url string")
    assert [r["verdict"] for r in url_rules.judged(twice).collect()] == ["block"] * 2
