"""URL filter: a broadcast trie over reversed host labels and path segments.

A rule is (verdict, host, path). It fits its host and all subdomains, if the
url's path starts with the rule's path. Among the rules that fit, the one with
the longest host wins, then the one with the longest path; an equal rule on both
lists blocks. Urls without a fitting rule get the default verdict.

The rules are cut into blocks of a stated size, one broadcast trie each, and
every block is one narrow ``mapInArrow`` pass that keeps the better of the
rules found so far; there is no shuffle however many rules there are.

Null urls and urls without ``://`` have an empty host and path. Repeated rows
are judged one by one; other columns are never read. Without rules every url
gets the default.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 32 << 20      # memory of a broadcast trie, as counted below
NODE_BYTES, RULE_BYTES = 300, 250       # a node with its key, and a rule's own strings and tuple
Rule = tuple[str, str, str]
_HERE = "\0"                # key of a node's rules; no label or segment holds it


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nested dicts: host labels from the right, then (under ``_HERE``) path
    segments; the last segment of a rule's path is a prefix, so it is kept at
    its node as (prefix, path, rule, verdict)."""
    root: dict = {}
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node.setdefault(label, {})
        node = node.setdefault(_HERE, {})
        *whole, last = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        node.setdefault(_HERE, []).append((last, path, host + path, verdict))
    return root


def find(root: dict, host: str, path: str) -> tuple[int, int, str, str] | None:
    """(labels, path length, rule, verdict) of the rule that wins."""
    node, depth, best = root, 0, None
    segments = path.split("/")
    labels = host.split(".") if host else []
    for i in range(len(labels) + 1):
        at = node.get(_HERE)
        k = 0
        while at is not None:
            for last, rule_path, rule, verdict in at.get(_HERE, ()):
                if k < len(segments) and segments[k].startswith(last):
                    got = (depth, len(rule_path), rule, verdict)
                    if best is None or got[:2] > best[:2] or got[:2] == best[:2] and verdict == "block":
                        best = got
            at = at.get(segments[k]) if k < len(segments) else None
            k += 1
        if i == len(labels):
            break
        node = node.get(labels[-1 - i])
        if node is None:
            break
        depth += 1
    return best


def rule_blocks(rules: Iterable[Rule], limit: int = BLOCK_BYTES) -> Iterator[list[Rule]]:
    """Rules in blocks of ``limit`` bytes, as if no two rules shared a node."""
    block, size = [], 0
    for r in rules:
        n = NODE_BYTES * (r[1].count(".") + r[2].count("/") + 3) + 2 * (len(r[1]) + len(r[2])) + RULE_BYTES
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append(r)
        size += n
    if block:
        yield block


_FOUND = "labels int, path_len int, rule string, verdict string"


def filter_urls(pages: DataFrame, rules: Iterable[Rule], default: str = "allow", id_col: str = "page_id",
                url_col: str = "url", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, host, path, rule (null if none), verdict."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    url = pages[url_col]
    has = F.instr(url, "://") > 0
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    df = pages.select(
        pages[id_col].alias(id_col),
        F.when(has, F.translate(host, upper, lower)).otherwise("").alias("host"),
        F.when(has, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("").alias("path"),
        F.lit(-1).alias("labels"), F.lit(-1).alias("path_len"),
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    id_type = df.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, host string, path string, {_FOUND}"
    for block in rule_blocks(rules, block_bytes):
        df = df.mapInArrow(_lookup(df.sparkSession.sparkContext.broadcast(build_trie(block))), schema)
    return df.select(F.col(f"`{id_col}`"), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _lookup(trie):
    def run(batches):
        root = trie.value
        for b in batches:
            _, hosts, paths, *found = (c.to_pylist() for c in b.columns)
            rows = list(zip(*found))
            for i, (h, p) in enumerate(zip(hosts, paths)):
                got = find(root, h, p)
                old = rows[i]
                if got and (got[:2] > old[:2] or got[:2] == old[:2] and got[3] == "block"):
                    rows[i] = got
            new = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(3)]
                + [pa.array(v, t) for v, t in zip(new, (pa.int32(), pa.int32(), pa.string(), pa.string()))],
                names=b.schema.names)
    return run
