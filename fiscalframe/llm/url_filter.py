"""Allow and block lists for URLs: a trie over reversed host labels and path segments.

A rule is ``host/path``. It fits its host and all subdomains, for paths that
start with the rule's. Of the rules that fit, the longest wins: the one with
most host labels, then the one with the longest path; where the same entry is
both allowed and blocked, the block wins. URLs that no rule fits get the
default verdict. The trie is broadcast; its size is checked first.

Defined results: a null url or one without ``://`` has an empty host and an
empty path, and no rule fits it. Host labels may be empty (``a..com``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRIE_BYTES = 128 << 20

# Keys of a trie node that no label or segment can equal.
_PATHS, _ENDS = 0, 1


def build_trie(rules: Iterable[tuple[str, str]]) -> dict:
    """Nested dicts: host labels from the last to the first, then whole path segments.

    A node's _PATHS holds the path trie of the host that ends there. A path
    node's _ENDS maps what the rule has after its last whole segment to the
    rule and its verdict; a url fits if its next segment starts with that.
    """
    root: dict = {}
    for rule, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r} of {rule!r} is neither allow nor block")
        host, slash, path = rule.partition("/")
        node = root
        for label in reversed(host.lower().split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(_PATHS, {})
        *whole, rest = (slash + path).split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(_ENDS, {})
        if ends.get(rest, ("", "allow"))[1] == "allow":
            ends[rest] = (rule, verdict)
    return root


def find_rule(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    best, node = None, trie
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        # A longer host wins over any path, and so does a longer path on one host.
        at = node.get(_PATHS)
        for i, segment in enumerate(segments):
            if at is None:
                break
            if _ENDS in at:
                left = "/".join(segments[i:])
                fitting = [rest for rest in at[_ENDS] if left.startswith(rest)]
                if fitting:
                    best = at[_ENDS][max(fitting, key=len)]
            at = at.get(segment)
    return best


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], url: str = "url", keys: tuple[str, ...] = ("page_id",), default: str = "allow") -> DataFrame:
    """The key columns with ``host, path, rule, verdict``."""
    trie = build_trie(rules)
    if len(pickle.dumps(trie)) > MAX_TRIE_BYTES:
        raise ValueError(f"the rules take more than {MAX_TRIE_BYTES} bytes as a trie")
    shared = pages.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf("rule string, verdict string")
    def judged(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [find_rule(shared.value, h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    parts = pages.select(*keys, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    return parts.withColumn("_found", judged("host", "path")).select(*keys, "host", "path", "_found.rule", "_found.verdict")
