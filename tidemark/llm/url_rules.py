"""URL filter by pattern rules, indexed by their rarest literal token.

A rule is a regular expression over ``host + path``. The literal tokens every match must hold
are read off the parsed expression. The index files each rule under that of its tokens that the
fewest rules share. A url's own tokens fetch candidate rules, and only those run their
expressions; rules without any token run for all urls. Host rules (host and path prefix) are
rules of the same kind, and ``filter_rules`` reads lists in the common filter syntax.

Among host rules that fit a url the longest wins and is returned. Where none fits, the pattern
rules decide: a blocking pattern that matches gives ``block`` unless an allowing one (``@@``)
matches too; else the url is allowed.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
case, the path what follows up to ``?``, ``#`` or the end. A null url, or one without ``://``,
has an empty host and path and is allowed. Rules equal in length are taken in the order given.
Repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from re import _constants as op, _parser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile(r"[^\W_]+")
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


class Rule(NamedTuple):
    verdict: str
    name: str | None  # returned for host rules, None for patterns
    pattern: str
    tokens: tuple[str, ...]


def host_rule(verdict: str, name: str) -> Rule:
    """A rule for a host, its subdomains and a path prefix, from text like ``example.net/en/``."""
    host, slash, path = name.partition("/")
    # A path prefix may end within a longer token, so only its whole tokens are sure.
    whole = _TOKEN.findall(host) + _TOKEN.findall(re.sub(r"[^\W_]+$", "", path))
    return Rule(verdict, name, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", tuple(whole))


# In the outline of an expression: what bounds a token on either side, and what is not known.
BOUND, UNKNOWN = "", None
_BOUNDS = {op.AT_BEGINNING, op.AT_BEGINNING_STRING, op.AT_END, op.AT_END_STRING, op.AT_BOUNDARY}
_REPEATS = {op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT}


def _between_tokens(members: list) -> bool:
    """Whether no character of a set can be part of a token."""
    if members[0][0] is op.NEGATE:
        return (op.CATEGORY, op.CATEGORY_WORD) in members
    for kind, value in members:
        if kind is op.LITERAL or kind is op.RANGE:
            low, high = value if kind is op.RANGE else (value, value)
            if high - low > 255 or _TOKEN.search("".join(map(chr, range(low, high + 1)))):
                return False
        elif value not in (op.CATEGORY_SPACE, op.CATEGORY_NOT_WORD):
            return False
    return True


def _outline(parsed: Iterable) -> list[str | None]:
    """Token characters that are sure to stand there, ``BOUND`` and ``UNKNOWN``, in order."""
    out: list[str | None] = []
    for kind, value in parsed:
        if kind is op.LITERAL:
            out.append(chr(value) if _TOKEN.match(chr(value)) else BOUND)
        elif kind is op.IN:
            out.append(BOUND if _between_tokens(value) else UNKNOWN)
        elif kind is op.AT:
            out.append(BOUND if value in _BOUNDS else UNKNOWN)
        elif kind is op.SUBPATTERN and not value[1] and not value[2]:
            out += _outline(value[3])
        elif kind is op.BRANCH:
            ways = [_outline(way) for way in value[1]]
            out.append(BOUND if all(way and not any(s != BOUND for s in way) for way in ways) else UNKNOWN)
        elif kind in _REPEATS:
            inner = _outline(value[2]) or [UNKNOWN]
            if value[0]:
                out += [BOUND] * (inner[0] == BOUND) + [UNKNOWN] + [BOUND] * (inner[-1] == BOUND)
            else:  # it may be left out
                out.append(BOUND if inner[-1] == BOUND and out[-1:] == [BOUND] else UNKNOWN)
        else:
            out.append(UNKNOWN)
    return out


def sure_tokens(pattern: str) -> tuple[str, ...]:
    """Tokens that stand whole in every match of an expression."""
    if re.compile(pattern).flags & re.IGNORECASE:
        return ()
    found, run, bounded = [], "", False
    for sign in [*_outline(_parser.parse(pattern)), UNKNOWN]:
        if sign:
            run += sign
            continue
        if run and bounded and sign == BOUND:
            found.append(run)
        run, bounded = "", sign == BOUND
    return tuple(dict.fromkeys(found))


def pattern_rule(verdict: str, pattern: str) -> Rule:
    """A rule for an expression over host and path."""
    return Rule(verdict, None, pattern, sure_tokens(pattern))


def filter_rule(line: str) -> Rule | None:
    """A rule from a line of a filter list; None for blank lines, remarks, headings and rules on page elements.

    ``||`` at the start is a host or any of its subdomains, ``|`` a beginning or an end, ``*`` any
    text, ``^`` one character that is no letter, digit, ``_``, ``-``, ``.`` or ``%``, or the end.
    ``@@`` allows, ``/.../`` is an expression. Hosts are in lower case, in paths case counts. The
    scheme takes no part, and ``$`` options are an error: they ask for more than a url.
    """
    body = line.strip()
    if not body or body[0] in "![" or "##" in body or "#@#" in body:
        return None
    verdict = "allow" if body.startswith("@@") else "block"
    body = body.removeprefix("@@")
    if len(body) > 2 and body[0] == body[-1] == "/":
        return pattern_rule(verdict, body[1:-1])
    if "$" in body:
        raise ValueError(f"options of filter rules are not read: {line}")
    start = r"^(?:[^/]*\.)?" if body.startswith("||") else "^" if body.startswith("|") else ""
    body = body.lstrip("|")
    end = "$" if body.endswith("|") else ""
    signs = {"*": r"[\s\S]*", "^": r"(?:[^\w.%-]|$)"}
    return pattern_rule(verdict, start + "".join(signs.get(c) or re.escape(c) for c in body.rstrip("|")) + end)


def filter_rules(lines: Iterable[str]) -> tuple[Rule, ...]:
    """The rules of a filter list, a bounded list its user keeps."""
    return tuple(rule for rule in map(filter_rule, lines) if rule)


HOST_RULES = (
    host_rule("block", "net/"), host_rule("allow", "example.net/en/"), host_rule("block", "example.com/de/"), host_rule("allow", "org/fr/"),
)
# Hosts and paths of gambling, pill, advert and link-farm sites.
PATTERN_RULES = (
    pattern_rule("block", r"^(?:[^/]*[.-])?(?:free|best|live)-bets[.-]"),
    pattern_rule("block", r"^(?:[^/]*[.-])?(?:cheap|buy|online)-pills[.-]"),
    pattern_rule("block", r"^(?:[^/]*[.-])?casino[.-]"),
    pattern_rule("block", r"^(?:[^/]*[.-])?ads?-track[.-]"),
    pattern_rule("block", r"^(?:[^/]*[.-])?ads?-server[.-]"),
    pattern_rule("block", r"^(?:[^/]*[.-])?spam-farm[.-]"),
    pattern_rule("block", r"^(?:[^/]*[.-])?porn[.-]"),
    pattern_rule("block", r"/xxx(?:/|$)"),
)


class Index:
    """Rules by their rarest token."""

    def __init__(self, rules: tuple[Rule, ...]):
        shared = Counter(t for rule in rules for t in set(rule.tokens))
        self.by_token: dict[str, list[tuple[int, Rule, re.Pattern]]] = {}
        self.always: list[tuple[int, Rule, re.Pattern]] = []
        for place, rule in enumerate(rules):
            entry = (place, rule, re.compile(rule.pattern))
            rarest = min(rule.tokens, key=lambda t: (shared[t], -len(t), t), default=None)
            (self.always if rarest is None else self.by_token.setdefault(rarest, [])).append(entry)

    def judged(self, host: str, path: str) -> tuple[str | None, str]:
        """(host rule or None, verdict)."""
        if not host:
            return None, "allow"
        target = host + path
        candidates = list(self.always)
        for token in set(_TOKEN.findall(target)):
            candidates += self.by_token.get(token, ())
        best, blocked, excepted = None, False, False
        for place, rule, pattern in candidates:
            if pattern.search(target):
                if rule.name is None:
                    blocked, excepted = blocked or rule.verdict == "block", excepted or rule.verdict == "allow"
                elif best is None or (-len(rule.name), place) < (-len(best[1].name), best[0]):
                    best = (place, rule)
        if best:
            return best[1].name, best[1].verdict
        return None, "block" if blocked and not excepted else "allow"


def _judge(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(tuple(Rule(*rule) for rule in shared.value))
        for batch in batches:
            found = [index.judged(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            rules, verdicts = pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rules, verdicts], [*batch.schema.names, "rule", "verdict"])
    return run


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule and verdict per page. ``rules`` is a list the user writes."""
    shared = pages.sparkSession.sparkContext.broadcast([tuple(rule) for rule in rules])  # plain values: workers may lack this module
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    return rows.mapInArrow(_judge(shared), "page_id long, host string, path string, rule string, verdict string")
