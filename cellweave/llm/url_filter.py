"""URL filters: a trie over reversed host labels and path segments, sent to every task."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import without
from cellweave.session import ship

_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_LOWER = {i: i + 32 for i in range(65, 91)}
#: Rules in one broadcast trie, and their characters; more rules go in further tries, one pass each.
RULES_PER_TRIE, CHARS_PER_TRIE = 200_000, 16_000_000


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for paths that start with ``path``; ``action`` is allow or block."""

    host: str
    path: str
    action: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty for a null or a url without ``://``."""
    found = _PARTS.search(url) if url else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


@dataclass
class _PathNode:
    """After whole segments: rules that end inside the next segment, by that beginning; its lengths, longest first."""

    below: dict[str, _PathNode] = field(default_factory=dict)
    ends: dict[str, Rule] = field(default_factory=dict)
    lengths: list[int] = field(default_factory=list)


@dataclass
class _HostNode:
    below: dict[str, _HostNode] = field(default_factory=dict)
    paths: _PathNode | None = None


class UrlTrie:
    """Longest rule first: most characters of host and path; then the longer host; then block over allow."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _HostNode()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.below.setdefault(label, _HostNode())
            if node.paths is None:
                node.paths = _PathNode()
            place = node.paths
            *whole, rest = rule.path.split("/")
            for segment in whole:
                place = place.below.setdefault(segment, _PathNode())
            known = place.ends.get(rest)
            if known is None or rule.action == "block":
                place.ends[rest] = rule
            if len(rest) not in place.lengths:
                place.lengths = sorted([*place.lengths, len(rest)], reverse=True)

    def match(self, host: str, path: str) -> Rule | None:
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None:
                best = longer(best, self._path(node.paths, segments))
        return best

    @staticmethod
    def _path(node: _PathNode, segments: list[str]) -> Rule | None:
        found = None
        for segment in segments:
            for n in node.lengths:
                if n <= len(segment) and (rule := node.ends.get(segment[:n])):
                    found = rule  # longer than those of the segments before
                    break
            node = node.below.get(segment)
            if node is None:
                break
        return found


def _rank(rule: Rule) -> tuple:
    return (len(rule.name), len(rule.host), rule.action == "block")


def longer(a: Rule | None, b: Rule | None) -> Rule | None:
    if a is None or b is None:
        return a or b
    return max(a, b, key=_rank)


def tries(rules: list[Rule]) -> list[list[Rule]]:
    """Rules in groups, each within the bound of one broadcast."""
    groups, chars = [[]], 0
    for rule in rules:
        if len(groups[-1]) >= RULES_PER_TRIE or chars + len(rule.name) > CHARS_PER_TRIE:
            groups.append([])
            chars = 0
        groups[-1].append(rule)
        chars += len(rule.name)
    return groups


def judge_urls(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``df``.

    A null url, an empty one and one without ``://`` have empty host and path, no rule, and
    the default verdict. Repeated rows are judged alike. Input columns with the four names
    are replaced. Only the url goes to Python; each trie is bounded (see ``tries``), and
    more rules mean more passes in the same task, never a larger broadcast.
    """
    ship(df.sparkSession)
    out = without(df, *({"host", "path", "rule", "verdict"} - {url.lower()}))
    shards = [df.sparkSession.sparkContext.broadcast(UrlTrie(group)) for group in tries(rules)]

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for text in urls:
            host, path = split_url(text if isinstance(text, str) else None)
            best = None
            for shard in shards:
                best = longer(best, shard.value.match(host, path))
            rows.append((host, path, best.name if best else None, best.action if best else default))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    keep = [F.col(f"`{c}`") for c in out.columns]
    return out.select(*keep, judge(F.col(f"`{url}`")).alias("__cw_judged")).select(*keep, "__cw_judged.*")
