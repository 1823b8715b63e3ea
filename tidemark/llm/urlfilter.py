"""Allow and block rules for urls: a trie over reversed host labels and path segments, longest match first."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.order import unused

MAX_RULES = 100_000


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


@dataclass(slots=True)
class _Path:
    """A place after whole segments; `starts` holds rules that end within the next segment."""

    rule: int = -1
    next: dict[str, _Path] = field(default_factory=dict)
    starts: dict[str, int] = field(default_factory=dict)


@dataclass(slots=True)
class _Host:
    paths: _Path | None = None
    next: dict[str, _Host] = field(default_factory=dict)


def _segments(path: str) -> list[str]:
    """'/en/12' as '/', 'en/', '12': every segment but the last ends with its slash."""
    return path.replace("/", "/\0").split("\0")


class UrlTrie:
    """The rules of one table. Of two rules for the same host and path, block counts."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.rules: list[Rule] = []
        self.root = _Host()
        for rule in rules:
            rule = Rule(*rule)
            if rule.verdict not in ("allow", "block") or not rule.host:
                raise ValueError(f"a rule needs allow or block and a host: {rule}")
            self.rules.append(rule)
            if len(self.rules) > MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules: they are sent to every task")
            self._add(len(self.rules) - 1, rule)

    def _add(self, at: int, rule: Rule) -> None:
        host = self.root
        for label in reversed(rule.host.lower().split(".")):
            host = host.next.setdefault(label, _Host())
        host.paths = place = host.paths or _Path()
        *whole, rest = _segments(rule.path)
        for segment in whole:
            place = place.next.setdefault(segment, _Path())
        old = place.starts.get(rest, -1) if rest else place.rule
        if old >= 0 and self.rules[old].verdict == "block":
            return
        if rest:
            place.starts[rest] = at
        else:
            place.rule = at

    def match(self, host: str, path: str) -> Rule | None:
        """The rule with the most characters that fits, the longer host first among equals."""
        best: Rule | None = None
        place: _Host | None = self.root
        segments = _segments(path)
        for label in reversed(host.split(".")):
            place = place.next.get(label) if place else None
            if place is None:
                break
            if place.paths:
                for at in self._paths(place.paths, segments):
                    rule = self.rules[at]
                    if best is None or len(rule.host) + len(rule.path) >= len(best.host) + len(best.path):
                        best = rule
        return best

    @staticmethod
    def _paths(place: _Path, segments: list[str]) -> Iterator[int]:
        for segment in segments:
            if place.rule >= 0:
                yield place.rule
            for k in range(1, len(segment) + 1) if place.starts else ():
                if segment[:k] in place.starts:
                    yield place.starts[segment[:k]]
            if segment not in place.next:
                return
            place = place.next[segment]
        if place.rule >= 0:
            yield place.rule


def judge_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]], *, url_col: str = "url", default: str = "allow",
) -> DataFrame:
    """`pages` with columns host, path, rule and verdict added (columns of those names are replaced).

    host is what follows the first '://' up to '/', '?', '#' or the end, with A-Z in lower case; path is
    the rest up to '?', '#' or the end. A null url, or one without '://', has both empty and gets no rule.
    A rule (verdict, host, path) fits its host and all subdomains where the path begins with the rule's;
    the longest rule decides, the longer host among equals. `rule` is its host and path, or null, and
    verdict then is `default`. Every row is kept, repeated ones too; an empty table stays empty. The trie
    of at most MAX_RULES rules is sent to every task.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [trie.value.match(h, p) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame({
            "rule": [r and r.host + r.path for r in found],
            "verdict": [r.verdict if r else default for r in found],
        }, dtype=object)

    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    parts = r"^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, "(?s)" + parts, 1), string.ascii_uppercase, string.ascii_lowercase)
    [judged] = unused(pages, "judged")
    return (
        pages.withColumns({"host": host, "path": F.regexp_extract(url, "(?s)" + parts, 2)})
        .withColumn(judged, judge("host", "path"))
        .withColumns({"rule": F.col(f"{judged}.rule"), "verdict": F.col(f"{judged}.verdict")}).drop(judged)
    )
