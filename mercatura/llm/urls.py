"""URL filters: a trie over reversed host labels and path segments, with longest-match precedence.

A rule is a host and a path. It fits its host and every subdomain whose path starts with the rule's path. Of
the rules that fit, the one with most host labels wins, then the one with the longest path. Urls that no rule
fits get the default verdict.

Null urls, and urls without ``://``, have an empty host and path, fit no rule and get the default verdict. A
url without a path fits only rules with an empty path. Of equal rules the last one counts. Repeated urls are
judged alike; an empty table gives an empty table. Only ``id_col`` and ``url_col`` are read, so other columns
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import bounded_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules are broadcast; a list beyond this many characters is refused.
MAX_RULE_CHARS = 64 << 20


@dataclass(slots=True)
class Node:
    """``whole`` follows complete path segments; ``partial`` are rules whose path ends within a segment."""

    labels: dict[str, Node] = field(default_factory=dict)
    whole: dict[str, Node] = field(default_factory=dict)
    partial: list[tuple[str, str, str]] = field(default_factory=list)

    def child(self, edges: str, key: str) -> Node:
        return getattr(self, edges).setdefault(key, Node())


def build_trie(rules: Iterable[tuple[str, str, str]]) -> Node:
    """Trie of (verdict, host, path) rules."""
    root = Node()
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.child("labels", label)
        *whole, rest = path.split("/")
        for segment in whole:
            node = node.child("whole", segment)
        node.partial = [x for x in node.partial if x[0] != rest]
        node.partial.append((rest, host + path, verdict))
        node.partial.sort(key=lambda x: -len(x[0]))
    return root


def _on_path(node: Node, segments: list[str]) -> tuple[str, str] | None:
    """The deepest rule below a host's node that the path starts with."""
    best = None
    for depth, segment in enumerate(segments):
        best = next((x[1:] for x in node.partial if segment.startswith(x[0])), best)
        # only a segment that is followed by a slash is complete
        if depth + 1 == len(segments) or segment not in node.whole:
            break
        node = node.whole[segment]
    return best


def longest_match(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits, or None."""
    node, best, segments = root, None, path.split("/")
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        best = _on_path(node, segments) or best
    return best


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Host, path, matching rule (null if none) and verdict of every url, without a shuffle."""
    size = sum(len(part) for rule in rules for part in rule)
    if size > MAX_RULE_CHARS:
        raise ValueError(f"the rules have {size} characters; at most {MAX_RULE_CHARS} are broadcast")
    spark = pages.sparkSession
    bounded_batches(spark)
    trie = spark.sparkContext.broadcast(build_trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            found = [longest_match(trie.value, *pair) or (None, default) for pair in pairs]
            rule = pa.array([x[0] for x in found], pa.string())
            verdict = pa.array([x[1] for x in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, rule, verdict], [*batch.schema.names, "rule", "verdict"]
            )

    url = F.col(url_col)
    parts = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    kind = dict(parts.dtypes)["page_id"]
    return parts.mapInArrow(
        judge, f"page_id {kind}, host string, path string, rule string, verdict string"
    )
