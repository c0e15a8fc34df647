"""URL filter: allow and block rules in a trie of reversed host labels and path segments."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.llm.common import lower_ascii

ALLOW, BLOCK = "allow", "block"
# A rule list up to this size (text bytes) becomes one trie that every task gets. Its memory is a
# small multiple of that. Longer lists are joined with the urls instead.
TRIE_BYTES = 8 << 20
OURS = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class Rule:
    """A verdict on a host with all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = ""


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where it is null or has no ``://``."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + F.lit(3), F.char_length(url)))
    rest = F.coalesce(rest, F.lit(""))
    before = F.regexp_extract(rest, r"^[^?#]*", 0)
    host = F.regexp_extract(before, r"^[^/]*", 0)
    return lower_ascii(host), F.substring(before, F.char_length(host) + 1, F.char_length(before))


class RuleTrie:
    """Rules by reversed host labels, then by path segments.

    A node is a dictionary of its children; under ``None`` a host node keeps the root of its path
    trie. A path node keeps its children by whole segment and, under ``None``, the rules that end
    inside its next segment, as (text the segment starts with, rule). ``/en/`` so ends in an empty
    beginning after the segment ``en``: any segment may follow, but there must be one.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")) if rule.host else ():
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, rest = rule.path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            node.setdefault(None, []).append((rest, rule))

    def path_tries(self, host: str) -> list[dict]:
        """The path tries of the host and of all domains over it."""
        node, found = self.root, []
        if None in node:
            found.append(node[None])
        end = len(host)
        while host and end >= 0:
            begin = host.rfind(".", 0, end) + 1
            node = node.get(host[begin:end])
            if node is None:
                break
            if None in node:
                found.append(node[None])
            end = begin - 1
        return found

    @staticmethod
    def fitting(node: dict, path: str) -> Iterator[Rule]:
        """The rules of one path trie that the path starts with."""
        begin = 0
        while True:
            for rest, rule in node.get(None, ()):
                if path.startswith(rest, begin):
                    yield rule
            end = path.find("/", begin)
            if end < 0:
                return
            node = node.get(path[begin:end])
            if node is None:
                return
            begin = end + 1


def precedence(rule: Rule) -> tuple:
    """The longest rule wins; of equal lengths the one with the longer host, then a block."""
    return len(rule.host) + len(rule.path), len(rule.host), rule.verdict == BLOCK


def _told_by_trie(pages: DataFrame, rules: list[Rule]) -> Column:
    shared = pages.sparkSession.sparkContext.broadcast(pickle.dumps(RuleTrie(rules)))

    @F.pandas_udf("rule string, verdict string")
    def tell(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = pickle.loads(shared.value)
        for hosts, paths in parts:
            tries = {host: trie.path_tries(host) for host in hosts.unique()}
            found = []
            for host, path in zip(hosts, paths):
                fits = [rule for node in tries[host] for rule in trie.fitting(node, path)]
                best = max(fits, key=precedence, default=None)
                found.append((best.host + best.path, best.verdict) if best else (None, None))
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    return tell("host", "path")


def _told_by_join(pages: DataFrame, rules: DataFrame, labels_most: int, slashes_most: int) -> DataFrame:
    """The same decisions for rule lists that no task should hold.

    Every distinct host and beginning of a path up to a slash meets the rules with that host and
    whole segments; no rule has more labels and slashes than the two given numbers. Hosts and
    beginnings are made distinct before the join, so a rule for a very common host meets each
    beginning once; only those that have a rule go back to the urls.
    """
    labels = F.split("host", r"\.")
    hosts = F.transform(
        F.sequence(F.greatest(F.size(labels) - labels_most, F.lit(0)), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."),
    )
    segments = F.split("path", "/")
    # With its last slash; the first beginning is the empty one.
    heads = F.transform(
        F.sequence(F.lit(0), F.least(F.size(segments) - 1, F.lit(slashes_most))),
        lambda i: F.concat(F.array_join(F.slice(segments, 1, i), "/"), F.when(i > 0, "/").otherwise("")),
    )
    keyed = rules.select(
        F.col("host").alias("_rule_host"),
        F.regexp_extract("path", r"(?s)^(?:.*/)?", 0).alias("_head"),
        F.col("path").alias("_rule_path"),
        F.col("verdict").alias("_rule_verdict"),
    )
    urls = pages.select("host", "path").distinct()
    places = urls.select("host", "path", F.explode(F.array_distinct(hosts)).alias("_rule_host"))
    known_hosts = keyed.select("_rule_host").distinct()
    places = places.join(known_hosts, "_rule_host", "left_semi")
    places = places.select("*", F.explode(heads).alias("_head"))
    met = places.select("_rule_host", "_head").distinct().join(keyed, ["_rule_host", "_head"])
    fits = places.join(met, ["_rule_host", "_head"]).where(F.startswith("path", "_rule_path"))
    order = F.struct(
        (F.char_length("_rule_host") + F.char_length("_rule_path")).alias("length"),
        F.char_length("_rule_host").alias("host_length"),
        (F.col("_rule_verdict") == BLOCK).alias("blocks"),
    )
    told = F.struct(
        F.concat("_rule_host", "_rule_path").alias("rule"), F.col("_rule_verdict").alias("verdict")
    )
    best = fits.groupBy("host", "path").agg(F.max_by(told, order).alias("_told"))
    best = best.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "_told")
    same = (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p"))
    return pages.join(best, same, "left").drop("_h", "_p")


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = ALLOW,
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added.

    ``rules`` has ``verdict`` (allow or block), ``host`` and ``path``. A rule fits a url whose host
    is its host or a subdomain of it and whose path starts with its path. The longest rule (host
    and path together) decides; of equal lengths the longer host, then a block. Where no rule
    fits, ``rule`` is null and the verdict is ``default``. An empty rule host fits every host.
    Rules with nulls are no rules, and a repeated rule counts once.

    A url that is null or has no ``://`` has an empty host and an empty path. Columns of the four
    names are replaced, all others are passed through; an empty table gives an empty table.

    The rule list is measured first. Up to ``trie_bytes`` it is broadcast as one trie and no row
    is moved; a longer one is joined by host and path beginning, with the same result.
    """
    rules = rules.select(
        "verdict", lower_ascii(F.col("host")).alias("host"), F.col("path")
    ).dropna().distinct()
    texts = F.octet_length("host") + F.octet_length("path")
    size, labels, slashes = rules.agg(
        F.coalesce(F.sum(texts), F.lit(0)) + F.count(F.lit(1)) * 64,
        F.max(F.size(F.split("host", r"\."))),
        F.max(F.size(F.split("path", "/")) - 1),
    ).first()
    host, path = parsed(F.col(url))
    kept = [name for name in pages.columns if name not in OURS]
    given = pages.select(*[F.col(f"`{n}`") for n in kept], host.alias("host"), path.alias("path"))
    if size <= trie_bytes:
        listed = [Rule(row["verdict"], row["host"], row["path"]) for row in rules.collect()]
        told = given.withColumn("_told", _told_by_trie(given, listed))
    else:
        told = _told_by_join(given, rules, labels, slashes)
    return told.select(
        *[F.col(f"`{n}`") for n in kept],
        "host",
        "path",
        F.col("_told.rule").alias("rule"),
        F.coalesce("_told.verdict", F.lit(default)).alias("verdict"),
    )
