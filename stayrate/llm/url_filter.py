"""URL filters: allow and block rules in a trie over reversed host labels and path segments.

A rule is a host and a path, written ``host/path``. It fits its host and all subdomains, if the URL's
path starts with the rule's. Of the rules that fit, the longest (characters of host and path) wins;
of equally long ones the longer host, and of one rule given with both verdicts, block. URLs that no
rule fits get the default verdict.

The trie is broadcast if its rules stay below ``MOST_RULE_BYTES``; larger rule sets are joined
(``matched_by_join``), which gives the same rows.

A NULL url, or one without ``://``, has an empty host and path, and no rule fits it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.scratch import without

MOST_RULE_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = ("allow", "block")
#: Keys of a trie node that are no labels or segments: the path part of a host, and a rule's end.
PATH, END = ("path",), ("end",)

Rule = tuple[str, str]


def parts_of(url: Column) -> tuple[Column, Column]:
    """(host, path) columns. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nested dictionaries: host labels from the last to the first, then the rule's complete path
    segments, then what the next segment must begin with."""
    root: dict = {}
    for verdict, rule in rules:
        if verdict not in VERDICTS:
            raise ValueError(f"unknown verdict {verdict}")
        host, path = split_rule(rule)
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(PATH, {})
        *whole, begun = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(END, {})
        ends[begun] = max(verdict, ends.get(begun, (verdict,))[0]), host + path
    return root


def look_up(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(verdict, rule) of the longest rule that fits."""
    best: tuple[int, int, str, str] | None = None
    segments = path.split("/")
    node, host_size = trie, -1
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        host_size += 1 + len(label)
        at = node.get(PATH)
        for segment in segments:
            if at is None:
                break
            for begun, (verdict, rule) in at.get(END, {}).items():
                if segment.startswith(begun):
                    found = (len(rule), host_size, verdict, rule)
                    best = max(best, found) if best else found
            at = at.get(segment)
    return best and best[2:]


def judged(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (NULL if none fits) and ``verdict``."""
    size = sum(len(v) + len(r) for v, r in rules)
    if size > MOST_RULE_BYTES:
        return matched_by_join(pages, pages.sparkSession.createDataFrame(rules, "verdict string, rule string"), url, default)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("struct<verdict string, rule string>")
    def best(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tree = trie.value
        for hosts, paths in batches:
            found = [look_up(tree, h, p) or (None, None) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["verdict", "rule"])

    out = without(pages.withColumn("_url", F.col(url)), "host", "path", "rule", "verdict")
    host, path = parts_of(F.col("_url"))
    found = out.withColumns({"host": host, "path": path}).withColumn("_best", best("host", "path"))
    return found.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))}).drop("_url", "_best")


def matched_by_join(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The same rows for rule sets of any size: a URL's host suffixes, at most one per label, are
    joined with the rules' hosts. Every distinct (host, path) is looked up once, so a host with a
    third of the rows does not weigh more than its distinct paths."""
    out = without(pages.withColumn("_url", F.col(url)), "host", "path", "rule", "verdict")
    host, path = parts_of(F.col("_url"))
    out = out.withColumns({"host": host, "path": path})
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = out.select("host", "path").distinct().withColumn("_suffix", F.explode(suffixes))
    at = F.locate("/", F.col("rule"))
    rule_host = F.translate(F.when(at > 0, F.substring("rule", F.lit(1), at - 1)).otherwise(F.col("rule")), UPPER, LOWER)
    rule_path = F.when(at > 0, F.substring("rule", at, F.length("rule"))).otherwise("")
    known = rules.select(rule_host.alias("_suffix"), rule_path.alias("_start"), F.col("verdict").alias("_verdict"))
    fits = asked.join(known, "_suffix").where(F.startswith("path", "_start"))
    text = F.concat("_suffix", "_start")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length(text), F.length("_suffix"), "_verdict", text.alias("rule"))).alias("_best"))
    found = out.join(best, ["host", "path"], "left")
    result = found.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce("_best._verdict", F.lit(default))})
    return result.select(*[c for c in out.columns if c not in ("host", "path", "_url")], "host", "path", "rule", "verdict")
