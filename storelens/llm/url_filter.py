"""URL filter: a trie over reversed host labels and path segments.

Rules are (host, path, verdict).  A rule fits its host and every subdomain when
the url's path starts with the rule's path.  The trie is walked once per url:
host labels from the right, and at each host node the path segments from the
left; the longest fitting rule decides, allow or block alike.

A path node's rules that end in an open segment are sorted, and those that can fit a url's
segment are its prefixes: one bisection each, however many rules a host has.  The trie is
broadcast: its size is bounded by ``max_rules``, and more rules than that are refused.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import column, free_name

MAX_RULES = 100_000
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

Rule = tuple[str, str, str]


class Trie:
    """Nodes are dicts; PATH holds a host node's path tree, ENDS a path node's rules by their open last segment."""

    PATH, ENDS = "/", "#"            # neither can be a host label

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for host, path, verdict in rules:
            host = host.translate(ASCII_LOWER)
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(("host", label), {})
            *whole, last = path.split("/")
            node = node.setdefault(self.PATH, {})
            for segment in whole:
                node = node.setdefault(("path", segment), {})
            # the last segment is open: /en fits /en, /en/x and /english
            node.setdefault(self.ENDS, {})[last] = (host + path, verdict)
        self._sort(self.root)

    def _sort(self, root: dict) -> None:
        """Make each node's rules (sorted segments, for each the longest other one that it starts with, rules)."""
        todo = [root]
        while todo:
            node = todo.pop()
            for key, below in node.items():
                if key == self.ENDS:
                    lasts = sorted(below)
                    inside: list[int] = []
                    for i, last in enumerate(lasts):
                        k = i - 1
                        while k >= 0 and not last.startswith(lasts[k]):
                            k = inside[k]
                        inside.append(k)
                    node[key] = lasts, inside, [below[x] for x in lasts]
                else:
                    todo.append(below)

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits and its verdict; at equal length the deeper host."""
        best: tuple[int, str | None, str | None] = (-1, None, None)
        segments = path.split("/")
        node = self.root
        for label in (None, *reversed(host.split("."))):
            if label is not None:
                node = node.get(("host", label))
                if node is None:
                    break
            at = node.get(self.PATH)
            for segment in segments:
                if at is None:
                    break
                if self.ENDS in at:
                    lasts, inside, found = at[self.ENDS]
                    k = bisect_right(lasts, segment) - 1
                    while k >= 0 and not segment.startswith(lasts[k]):
                        k = inside[k]
                    if k >= 0 and len(found[k][0]) >= best[0]:
                        best = (len(found[k][0]), *found[k])
                at = at.get(("path", segment))
        return best[1:]


def filter_urls(pages: DataFrame, rules: Iterable[Rule], *, url: str = "url",
                default: str = "allow", max_rules: int = MAX_RULES) -> DataFrame:
    """Add host, path, rule (null: none fits) and verdict to every row.

    The host stands after the first ``://`` up to ``/ ? #`` or the end, with A-Z
    lower-cased (port and user stay part of it); the path follows up to ``?``,
    ``#`` or the end.  A null url, or one without ``://``, has both empty, so no
    rule with a path fits and it gets ``default``.  Two rules of one text: the
    later one counts.  Columns of these four names are replaced.
    """
    rules = list(rules)
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; at most {max_rules} are broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            found = [trie.value.find(h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    given = F.coalesce(column(pages, url).cast("string"), F.lit(""))
    kept = [column(pages, c) for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    cut = pages.select(*kept, F.translate(F.regexp_extract(given, parts, 1), upper, lower).alias("host"),
                       F.regexp_extract(given, parts, 2).alias("path"))
    names = [f"`{c}`" for c in cut.columns]
    (held,) = free_name(cut, "judged")
    judged = cut.select(*names, judge("host", "path").alias(held))
    return judged.select(*names, F.col(held)["rule"].alias("rule"),
                         F.coalesce(F.col(held)["verdict"], F.lit(default)).alias("verdict"))
