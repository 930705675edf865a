"""Allow and block lists of hosts and paths.

Rules form a trie over reversed host labels and then path segments.  A URL
walks it once: host labels from the right, then whole path segments; the
deepest rule on the way wins, and of a block and an allow entry for the same
host and path the block entry holds.  A URL without a rule gets ``default``.

The trie is broadcast, so the rule list is bounded: more than ``MAX_RULES``
entries (a few hundred MB of trie) are matched by ``judge_by_join`` instead,
which joins every URL's own prefixes with the rule table.

Defined results: a NULL URL or one without ``://`` has an empty host and path
and matches no rule; repeated rows and NULL ids keep their own row; an empty
rule list gives ``default``; a URL of any length is judged whole; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches

MAX_RULES = 1_000_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    """Host and path: the path starts at the first slash."""
    host, slash, path = rule.partition("/")
    return host, slash + path


class RuleTrie:
    """Nodes are [rule, verdict, host labels, whole path segments, unfinished last segments]."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.top = self._node()
        for verdict, rule in rules:
            host, path = split_rule(rule)
            node = self.top
            for label in reversed(host.split(".")):
                node = node[2].setdefault(label, self._node())
            whole, last = self._segments(path)
            for segment in whole:
                node = node[3].setdefault(segment, self._node())
            if last:
                node = node[4].setdefault(last, self._node())
            if node[1] != "block":
                node[0], node[1] = rule, verdict

    @staticmethod
    def _node() -> list:
        return [None, None, {}, {}, {}]

    @staticmethod
    def _segments(path: str) -> tuple[list[str], str]:
        *whole, last = path.split("/")
        return [w + "/" for w in whole], last

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest fitting rule and its verdict."""
        found, node = [], self.top
        whole, last = self._segments(path)
        for label in reversed(host.split(".")):
            node = node[2].get(label)
            if node is None:
                break
            found += self._along(node, whole, last)
        if not found:
            return None, None
        best = max(found, key=lambda n: (len(n[0]), n[1] == "block"))
        return best[0], best[1]

    @staticmethod
    def _along(node: list, whole: list[str], last: str) -> Iterator[list]:
        """The nodes with a rule from a host's node down the path."""
        for segment in [*whole, last]:
            if node[1] is not None:
                yield node
            if node[4]:
                yield from (node[4][segment[:k]] for k in range(1, len(segment) + 1) if segment[:k] in node[4])
            node = node[3].get(segment)
            if node is None:
                return
        if node[1] is not None:
            yield node


def _addresses(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row, by the broadcast trie."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: use judge_by_join with a rule table")
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [trie.value.match(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in found], pa.string()), pa.array([v or default for _, v in found], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(_addresses(pages), run, f"page_id {kind}, host string, path string, rule string, verdict string")


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The same result for a rule table (verdict, rule) of any size.

    Every distinct address is joined on (host suffix, folder) with the rules;
    the longest fitting rule is a partial aggregate, so nothing is collected.
    """
    rules = rules.select("verdict", "rule", F.substring_index("rule", "/", 1).alias("r_host")).withColumn(
        "r_path", F.expr("substr(rule, char_length(r_host) + 1)"))
    rules = rules.withColumn("r_folder", F.regexp_extract("r_path", "^(.*/)?", 0))
    pages = _addresses(pages)
    known = pages.select("host", "path").distinct()
    labels, parts = F.split("host", "[.]"), F.split("path", "/")
    prefixes = known.select(
        "host", "path",
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, -i, i)))).alias("r_host"),
        F.transform(F.sequence(F.lit(0), F.size(parts) - 1),
                    lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))).alias("folders"))
    prefixes = prefixes.select("host", "path", "r_host", F.explode("folders").alias("r_folder"))
    fits = prefixes.join(rules, ["r_host", "r_folder"]).where(F.col("path").startswith(F.col("r_path")))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("verdict") == "block")).alias("best"))
    return pages.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
