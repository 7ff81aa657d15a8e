"""URL allow and block lists: a trie over reversed host labels and path segments.

A rule is a host and a path (``example.org/es/``).  It fits a URL when the URL's host is
the rule's host or one of its subdomains and the URL's path starts with the rule's path.
Of the rules that fit, the longest (characters of host and path) decides; of equally long
ones the one with the longer host; of the same rule in both lists, block.

The trie has one level per host label, from the right, then one per complete path segment;
the last segment of a rule is kept as a prefix, because a rule may end within a segment.
It is broadcast when the list has at most ``max_broadcast_rules`` rules.  A longer list is
joined instead: URLs and rules meet on (host, complete leading segments).

Defined results: a null URL or one without ``://`` has an empty host and path and gets the
default verdict; empty labels and segments are ordinary ones; repeated rows are judged
each; only the url column is read and all other columns are passed through, and columns of
the input that carry a result name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import lower_ascii, ship

MAX_BROADCAST_RULES = 200_000


class Rule(NamedTuple):
    verdict: str  # allow or block
    rule: str     # host and path


def parse_rule(verdict: str, rule: str) -> tuple[str, str, str, str]:
    host, slash, rest = rule.partition("/")
    return host.lower(), slash + rest, rule, verdict


class Trie:
    """Hosts by reversed labels; below each host node its paths by segments."""

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.root: dict = {}
        for verdict, text in rules:
            host, path, rule, _ = parse_rule(verdict, text)
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(("label", label), {})
            *full, part = path.split("/")
            for segment in full:
                node = node.setdefault(("segment", segment), {})
            known = node.setdefault("ends", {})
            if part not in known or verdict == "block":
                known[part] = (len(host) + len(path), len(host), rule, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        segments = path.split("/")
        best, node = None, self.root
        labels = host.split(".")
        for depth in range(len(labels) + 1):
            at = node
            for segment in segments:
                ends = at.get("ends")
                if ends:
                    for n in range(min(len(segment), max(map(len, ends))) + 1):
                        hit = ends.get(segment[:n])
                        if hit and (best is None or hit > best):
                            best = hit
                at = at.get(("segment", segment))
                if at is None:
                    break
            if depth == len(labels):
                break
            node = node.get(("label", labels[-1 - depth]))
            if node is None:
                break
        return best and best[2:]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: Sequence[Rule] | DataFrame, default: str = "allow", url: str = "url",
          max_broadcast_rules: int = MAX_BROADCAST_RULES) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    ``rules``: a list, or a DataFrame with columns ``verdict`` and ``rule`` for lists of
    any length.
    """
    host, path = split_url(F.col(url))
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(*[F.col(f"`{c}`") for c in others], host.alias("host"), path.alias("path"))
    if isinstance(rules, DataFrame):
        known = rules.select("verdict", "rule").where(F.col("rule").isNotNull() & F.col("verdict").isin("allow", "block"))
        first = known.limit(max_broadcast_rules + 1).collect()
        if len(first) > max_broadcast_rules:
            return _judge_by_join(parsed, known, default)
        rules = [Rule(*r) for r in first]
    elif len(rules) > max_broadcast_rules:
        frame = pages.sparkSession.createDataFrame([tuple(r) for r in rules], "verdict string, rule string")
        return _judge_by_join(parsed, frame, default)
    ship(pages.sparkSession)
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def decide(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = trie.value.find
        for hosts, paths in parts:
            yield pd.DataFrame([find(h, p) or (None, default) for h, p in zip(hosts, paths)],
                               columns=["rule", "verdict"])

    out = parsed.withColumn("__hit", decide("host", "path"))
    return out.select(*[F.col(f"`{c}`") for c in others], "host", "path", F.col("__hit.rule").alias("rule"),
                      F.col("__hit.verdict").alias("verdict"))


def _judge_by_join(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same result without a broadcast: each distinct (host, path) is looked up under
    every (suffix of its host, number and text of its leading complete segments)."""
    slash = F.instr("rule", "/")
    rule_host = F.when(slash > 0, F.substring("rule", F.lit(1), slash - 1)).otherwise(F.col("rule"))
    rule_path = F.when(slash > 0, F.substring("rule", slash, F.length("rule"))).otherwise(F.lit(""))
    segments = F.split("rule_path", "/")
    listed = (rules.select("verdict", "rule", F.lower(rule_host).alias("rule_host"), rule_path.alias("rule_path"))
              .select("verdict", "rule", "rule_host", F.size(segments).alias("depth"),
                      F.array_join(F.slice(segments, F.lit(1), F.size(segments) - 1), "/").alias("lead"),
                      F.element_at(segments, -1).alias("part"),
                      F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "rule", "verdict").alias("hit")))
    keys = parsed.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.array_distinct(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    parts = F.split("path", "/")
    leads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i - 1), "/").alias("lead"), F.element_at(parts, i).alias("segment")))
    asked = (keys.select("host", "path", F.explode(suffixes).alias("rule_host"), leads.alias("leads"))
             .select("host", "path", "rule_host", F.inline("leads")))
    found = (asked.join(listed, ["rule_host", "depth", "lead"])
             .where(F.col("segment").startswith(F.col("part")))
             .groupBy("host", "path").agg(F.max("hit").alias("hit")))
    joined = parsed.join(found, ["host", "path"], "left")
    others = [c for c in parsed.columns if c not in ("host", "path")]
    return joined.select(*[F.col(f"`{c}`") for c in others], "host", "path", F.col("hit.rule").alias("rule"),
                         F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
