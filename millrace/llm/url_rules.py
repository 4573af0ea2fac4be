"""URL filter: a trie over reversed host labels, then path segments, with longest-match precedence.

Rules are few and fixed when a job starts; their number and size are checked before the trie is shipped to the
executors. The work is one map over the rows: no shuffle, so hot hosts cost nothing extra.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A broadcast trie holds at most this many characters of rules; a longer list is refused.
MAX_RULE_CHARS = 64_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        """``net/de/`` becomes host ``net`` and path ``/de/``; a text without a slash means the whole host."""
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict must be allow or block, not {verdict!r}")
        host, slash, path = text.partition("/")
        if not host:
            raise ValueError(f"rule {text!r} names no host")
        return cls(verdict, host.translate(str.maketrans(UPPER, LOWER)), slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


class UrlTrie:
    """Host labels from the top-level domain inwards; at each host node, path segments from the root.

    The last piece of a rule's path need not end at a slash (``/en/7`` fits ``/en/77``), so it is kept as a
    list of open prefixes at the node of the segments before it, longest first.
    """

    def __init__(self, rules: Iterable[Rule], default: str = "allow"):
        self.default = default
        self.root: dict = {"next": {}, "paths": None}
        size = 0
        for rule in rules:
            size += len(rule.text)
            if size > MAX_RULE_CHARS:
                raise ValueError(f"more than {MAX_RULE_CHARS} characters of rules: too large to broadcast")
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node["next"].setdefault(label, {"next": {}, "paths": None})
            if node["paths"] is None:
                node["paths"] = {"next": {}, "open": {}}
            at = node["paths"]
            *whole, last = rule.path.split("/")
            for segment in whole:
                at = at["next"].setdefault(segment, {"next": {}, "open": {}})
            # the same rule in both lists: allow wins
            if at["open"].get(last, ("", "block"))[1] == "block":
                at["open"][last] = (rule.text, rule.verdict)
        self._sort(self.root)

    def _sort(self, host: dict) -> None:
        todo = [host["paths"]] if host["paths"] else []
        while todo:
            at = todo.pop()
            at["open"] = sorted(at["open"].items(), key=lambda x: -len(x[0]))
            todo.extend(at["next"].values())
        for child in host["next"].values():
            self._sort(child)

    def judge(self, host: str, path: str) -> tuple[str | None, str]:
        """(rule, verdict): the fitting rule with most characters; ties go to the longer host, then to allow."""
        best = None
        node, depth = self.root, 0
        segments = path.split("/")
        for label in reversed(host.split(".")) if host else ():
            node = node["next"].get(label)
            if node is None:
                break
            depth += 1
            at = node["paths"]
            for segment in segments if at else ():
                hit = next((found for prefix, found in at["open"] if segment.startswith(prefix)), None)
                if hit and (best is None or (len(hit[0]), depth, hit[1] == "allow") > best[0]):
                    best = ((len(hit[0]), depth, hit[1] == "allow"), hit)
                at = at["next"].get(segment)
                if at is None:
                    break
        return best[1] if best else (None, self.default)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    pattern = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def judge_urls(df: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """df with host, path, rule and verdict for the URL column.

    Null, empty or malformed URLs have an empty host and path, fit no rule and get the default verdict. Columns
    of df that have one of the four names are replaced; all others stay. Repeated rows each get their verdict.
    """
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules, default))

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def verdicts(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [trie.value.judge(h, p) for h, p in zip(host, path)]
        return pd.DataFrame({"rule": pd.Series([r for r, _ in found], dtype=object), "verdict": pd.Series([v for _, v in found], dtype=object)})

    host, path = split_url(F.col(url))
    out = df.withColumns({"__h": host, "__p": path}).withColumn("__v", verdicts("__h", "__p"))
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return out.select(*keep, F.col("__h").alias("host"), F.col("__p").alias("path"), F.col("__v.rule").alias("rule"), F.col("__v.verdict").alias("verdict"))
