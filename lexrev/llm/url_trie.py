"""URL filters: a trie over reversed host labels and path segments, with longest-match precedence.

A rule is a host, a path and a verdict (allow or block). It fits its host and all subdomains of it, if the URL's path
starts with the rule's path, character by character. The trie goes down a host's labels from the last to the first; every host node
may lead to a trie of path segments, in which what follows a path's last slash is kept as a stump that the next segment must start with. Of all
rules that fit, the one with the most host labels wins, among these the one with the longest path, and of an allow and
a block rule for the same host and path the block rule. URLs without a fitting rule get the default verdict.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased (port and user name
stay part of it); the path follows up to ``?``, ``#`` or the end. Without ``://`` both are empty.

Rules reach the tasks as broadcast tries of at most ``RULE_BLOCK`` rules and ``RULE_BYTES`` bytes of host and path. A longer list
takes further passes over the written hosts and paths, each of which keeps the better match: no list is refused.

Null URLs are empty; a rule with an empty host fits every URL; null hosts and paths of rules are empty, rules with any other
verdict than allow and block (null too) are ignored, repeated rules count once; repeated rows get equal results; other columns are ignored
by ``judge`` and kept by ``keep_allowed``, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexrev.llm.common import ascii_lower, map_batches
from lexrev.session import cut_lineage

ALLOW, BLOCK = "allow", "block"
RULE_BLOCK = 200_000
RULE_BYTES = 32 << 20
#: A match: host labels, length of the path, whether it blocks, rule. Better matches compare as greater.
Match = tuple[int, int, bool, str]


def host_and_path(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for mark in "#?":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return ascii_lower(host), slash + path


class Trie:
    """Rules by reversed host labels, then path segments. ``None`` leads from a host node to its paths, and from a
    path node to its stumps."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            labels = host.split(".")[::-1] if host else []
            for label in labels:
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *segments, stump = path.split("/")
            for s in segments:
                node = node.setdefault(s, {})
            stumps = node.setdefault(None, {})
            match = (len(labels), len(path), verdict == BLOCK, host + path)
            stumps[stump] = max(match, stumps.get(stump, match))

    def find(self, host: str, path: str) -> Match | None:
        """The best match of a URL."""
        node, hosts = self.root, [self.root.get(None)]
        for label in host.split(".")[::-1]:
            node = node.get(label)
            if node is None:
                break
            hosts.append(node.get(None))
        segments = path.split("/")
        for paths in reversed(hosts):
            best = self._longest(paths, segments) if paths is not None else None
            if best is not None:
                return best
        return None

    @staticmethod
    def _longest(node: dict, segments: list[str]) -> Match | None:
        best = None
        for s in segments:
            fits = [m for stump, m in node.get(None, {}).items() if s.startswith(stump)]
            best = max(fits, default=best)
            node = node.get(s)
            if node is None:
                break
        return best


def rule_blocks(rules: DataFrame, rows: int = RULE_BLOCK, size: int = RULE_BYTES) -> Iterator[list[tuple[str, str, str]]]:
    """The usable rules (host, path, verdict) in blocks of bounded length."""
    usable = rules.where(F.col("verdict").isin(ALLOW, BLOCK)).select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")], "verdict").distinct()
    block, length = [], 0
    for r in usable.toLocalIterator():
        block.append((ascii_lower(r["host"]), r["path"], r["verdict"]))
        length += len(r["host"]) + len(r["path"])
        if len(block) >= rows or length >= size:
            yield block
            block, length = [], 0
    if block:
        yield block


_BEST = [T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("labels", T.IntegerType()),
         T.StructField("path_length", T.IntegerType()), T.StructField("blocks", T.BooleanType()), T.StructField("rule", T.StringType())]


def _pass(table: DataFrame, block: list[tuple[str, str, str]], first: bool) -> DataFrame:
    """One block of rules against every row: (key, url) at first, afterwards (key, host, path, best match so far)."""
    sent = table.sparkSession.sparkContext.broadcast(Trie(block))  # at most RULE_BLOCK rules and RULE_BYTES bytes

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        trie = sent.value
        if first:
            at = [host_and_path(u) for u in b.column(1).to_pylist()]
            so_far = [None] * len(at)
        else:
            cols = [b.column(i).to_pylist() for i in range(1, 7)]
            at = list(zip(cols[0], cols[1], strict=True))
            so_far = [None if m[0] is None else m for m in zip(*cols[2:], strict=True)]
        best = [max((m for m in (old, trie.find(*hp)) if m is not None), default=(None,) * 4)
                for hp, old in zip(at, so_far, strict=True)]
        cols = [*(list(x) for x in zip(*at, strict=True)), *(list(x) for x in zip(*best, strict=True))]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                          names=["key", *(f.name for f in _BEST)])

    return map_batches(table, fn, T.StructType([table.schema[0], *_BEST]))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW,
          block_rules: int = RULE_BLOCK) -> DataFrame:
    """Verdict on every row of ``pages``: the key, host, path, rule (null without one), verdict.

    ``rules(host, path, verdict)`` may have any length.
    """
    table = None
    for block in rule_blocks(rules, block_rules):
        if table is None:
            table = _pass(pages.select(F.col(key).alias("key"), F.col(url).alias("url")), block, True)
        else:
            table = _pass(cut_lineage(table, "url-matches"), block, False)
    if table is None:
        table = _pass(pages.select(F.col(key).alias("key"), F.col(url).alias("url")), [], True)
    verdict = F.when(F.col("blocks"), F.lit(BLOCK)).when(~F.col("blocks"), F.lit(ALLOW)).otherwise(F.lit(default))
    return table.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"))


def keep_allowed(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` without the rows whose verdict is block; all columns as they came."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(pages.columns)])
    judged = judge(pages.select(row.alias("row"), F.col(f"`{url}`").alias("url")), rules, "row", "url", default)
    return judged.where(F.col("verdict") == ALLOW).select(
        *[F.col(f"row._c{i}").alias(c) for i, c in enumerate(pages.columns)])
