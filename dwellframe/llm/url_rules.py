"""URL filters: pattern rules indexed by their rarest literal token.

A rule's pattern has ``*`` for any characters, ``^`` for a separator or the end, ``|`` at either end for an
anchor, and ``||`` at its start for the start of the host or of one of its labels. A rule is filed, in a hash table, under
that of its literal tokens which is rarest among the URLs at hand. The tokens of a URL fetch the rules filed under them,
and only those rules' regular expressions run on it. Host rules are filed by host. So neither the plan nor the work on a
URL grows with the number of rules, only with those that it fetches.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.common import map_texts

TOKEN = r"[a-z0-9]+"
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
FIELDS = [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict", "pattern")]


class HostRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, rule: str) -> HostRule:
        host, slash, path = rule.partition("/")
        return cls(verdict, host.lower(), slash + path)

    def __str__(self) -> str:
        return self.host + self.path


class Pattern(NamedTuple):
    verdict: str
    pattern: str

    def regex(self) -> str:
        body = self.pattern.lower()
        label, end = body.startswith("||"), body.endswith("|")
        start = body.startswith("|") and not label
        body = body.removeprefix("|").removeprefix("|").removesuffix("|")
        made = "".join({"*": ".*", "^": "([^a-z0-9_.%-]|$)"}.get(c) or re.sub(r"([^a-z0-9/])", r"\\\1", c) for c in body)
        return "^[a-z]+://([^/?#]*[.])?" * label + "^" * start + made + "$" * end

    def tokens(self) -> list[str]:
        """Literal tokens that any matching URL must have as whole tokens: none next to ``*`` or an open end."""
        body = self.pattern.lower()
        anchored = ("|" if body.startswith("|") else "*") + body.strip("|") + ("|" if body.endswith("|") else "*")
        return re.findall(rf"(?<![a-z0-9*])({TOKEN})(?![a-z0-9*])", anchored)


def rule_list(rules: Sequence[tuple[str, str]]) -> list[HostRule]:
    return [HostRule.parse(*r) for r in rules]


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str | None) -> tuple[str, str]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#`` or the end."""
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match("[^?#]*", rest[len(host) :])[0]


def token_counts(urls: DataFrame, wanted: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each wanted token: at most one row per token of the rules."""
    spark = urls.sparkSession
    asked = F.broadcast(spark.createDataFrame([(t,) for t in sorted(set(wanted))], "token string"))  # configuration, not data
    tokens = F.explode(F.array_distinct(F.regexp_extract_all(lowered(F.col("url")), F.lit(TOKEN), F.lit(0))))
    rows = urls.select(tokens.alias("token")).join(asked, "token").groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


class RuleIndex:
    """Host rules by host, pattern rules by their rarest token. Regular expressions are compiled when first fetched."""

    def __init__(self, hosts: Sequence[HostRule], patterns: Sequence[Pattern], counts: dict[str, int]) -> None:
        self.patterns, self.made = list(patterns), {}
        self.by_host: dict[str, list[HostRule]] = {}
        for r in hosts:
            self.by_host.setdefault(r.host, []).append(r)
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for n, p in enumerate(self.patterns):
            if tokens := p.tokens():
                self.by_token.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(n)
            else:
                self.always.append(n)

    def host_rule(self, host: str, path: str) -> HostRule | None:
        """The longest fitting rule: of the host itself or of one that it is a subdomain of."""
        fits = []
        while True:
            fits += [r for r in self.by_host.get(host, ()) if path.startswith(r.path)]
            if "." not in host:
                return min(fits, key=lambda r: (-len(str(r)), str(r))) if fits else None
            host = host.split(".", 1)[1]

    def fetched(self, url: str) -> list[int]:
        """Numbers of the pattern rules that could match, in order."""
        found = {n for t in set(re.findall(TOKEN, url)) & self.by_token.keys() for n in self.by_token[t]}
        return sorted(found.union(self.always))

    def pattern_rule(self, url: str) -> Pattern | None:
        """The first allowing match, else the first match."""
        first = None
        for n in self.fetched(url):
            if (run := self.made.get(n)) is None:
                run = self.made[n] = re.compile(self.patterns[n].regex())
            if (first is None or self.patterns[n].verdict == "allow") and run.search(url):
                if self.patterns[n].verdict == "allow":
                    return self.patterns[n]
                first = self.patterns[n]
        return first


def judge_urls(pages: DataFrame, hosts: Sequence[HostRule], patterns: Sequence[Pattern], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict, pattern for every row of ``pages``.

    A fitting host rule decides. Otherwise the pattern rules do: an allowing match wins over blocking
    ones, the first in the list names the ``pattern``; without a match the verdict is ``default``.

    The rules are configuration: tasks get them once and file them. URLs are never shuffled. Rules without a usable token
    are tried on every URL. A null url or one without ``://`` has empty host and path; pattern rules see it all the same.
    Repeated rows are judged each; columns of ``pages`` other than page_id and url are ignored.
    """
    tokens = [t for p in patterns for t in p.tokens()]
    counts = token_counts(pages, tokens) if tokens else {}
    held = pages.sparkSession.sparkContext.broadcast((list(hosts), list(patterns), counts))

    def make():
        index = RuleIndex(*held.value)

        def judge(url: str | None) -> tuple:
            host, path = host_and_path(url)
            if rule := index.host_rule(host, path):
                return host, path, str(rule), rule.verdict, None
            found = index.pattern_rule((url or "").translate(LOWER))
            return host, path, None, found.verdict if found else default, found and found.pattern

        return lambda urls: list(zip(*map(judge, urls), strict=True))

    return map_texts(pages, make, FIELDS, keep=["page_id"], text="url")
