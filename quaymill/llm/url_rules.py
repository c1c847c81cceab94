"""URL rules by a sorted sweep: prefixes are intervals of reversed-host keys.

A host is turned around label by label, each followed by a dot (``blog.example.org`` becomes
``org.example.blog.``), so a host with all its subdomains is one interval of sorted keys, and rules
nest or are disjoint. A sweep over sorted keys pushes a host's rules when it enters their interval and
pops them when it leaves; what is on the stack is exactly what fits the host. The paths of the
rules on the stack are intervals as well, looked up by length from the longest.

Rows are swept where they are: each Arrow batch is sorted by key, joined and put back in order. No
shuffle is needed, so a host with a third of all rows is no key of any exchange. Rules come to the
tasks in blocks of at most RULES_PER_BLOCK rows, one sweep per block, so any number of rules works.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quaymill.llm.common import own_column

RULES_PER_BLOCK = 200_000
DEFAULT = "allow"


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def url_path(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: str) -> str:
    return "".join(f"{label}." for label in reversed(host.split(".")))


class RuleTree:
    """The rules of one block, by host in key order; each host has its paths and verdicts."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        by_host: dict[str, dict[str, str]] = {}
        for host, path, verdict in rules:
            paths = by_host.setdefault(host_key(host), {})
            # Of two verdicts for one rule, block wins.
            paths[path] = max(verdict, paths.get(path, verdict))
        self.keys = sorted(by_host)
        self.paths = [by_host[key] for key in self.keys]
        self.lengths = [sorted({len(path) for path in paths}, reverse=True) for paths in self.paths]

    def sweep(self, keys: list[str], paths: list[str]) -> Iterator[tuple[int, int, str, str] | None]:
        """For keys in sorted order the longest fitting rule: its size, host size, text, verdict."""
        stack: list[int] = []
        entered = 0
        for key, path in zip(keys, paths):
            while stack and not key.startswith(self.keys[stack[-1]]):
                stack.pop()
            # All rule hosts up to here; an interval that ended before this key holds no later one.
            while entered < len(self.keys) and self.keys[entered] <= key:
                if key.startswith(self.keys[entered]):
                    stack.append(entered)
                entered += 1
            yield self._longest(stack, path)

    def _longest(self, stack: list[int], path: str) -> tuple[int, int, str, str] | None:
        best: tuple[int, int, str, str] | None = None
        for at in reversed(stack):
            host_size = len(self.keys[at]) - 1
            for size in self.lengths[at]:
                if best and host_size + size <= best[0]:
                    break
                verdict = self.paths[at].get(path[:size]) if size <= len(path) else None
                if verdict:
                    host = ".".join(reversed(self.keys[at][:-1].split(".")))
                    best = (host_size + size, host_size, host + path[:size], verdict)
                    break
        return best


def _apply(tree: RuleTree, names: tuple[str, str, str, str, str]):
    host_name, path_name, rule_name, verdict_name, size_name = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(host_name).to_pylist(), batch.column(path_name).to_pylist()
            keys = [host_key(host) for host in hosts]
            order = sorted(range(len(keys)), key=keys.__getitem__)
            rules = batch.column(rule_name).to_pylist()
            verdicts = batch.column(verdict_name).to_pylist()
            sizes = batch.column(size_name).to_pylist()
            found = tree.sweep([keys[row] for row in order], [paths[row] for row in order])
            for row, fit in zip(order, found):
                # An earlier block's rule stands unless this one is longer.
                if fit and (rules[row] is None or fit[:2] > (len(rules[row]), sizes[row])):
                    _, sizes[row], rules[row], verdicts[row] = fit
            columns = dict(zip(batch.schema.names, batch.columns))
            columns[rule_name] = pa.array(rules, pa.string())
            columns[verdict_name] = pa.array(verdicts, pa.string())
            columns[size_name] = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = DEFAULT,
    rules_per_block: int = RULES_PER_BLOCK,
) -> DataFrame:
    """Append host, path, rule and verdict to the pages.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the url's path
    starts with the rule's; the longest (host and path together) wins, of equally long ones that
    with the longer host. A rule with null anywhere is no rule; of two verdicts for one rule block
    wins. Null urls and urls without :// have empty host and path, and fit only rules of the empty
    host. Without a rule the verdict is ``default``. Rows keep all columns; a new column whose
    name is taken gets a trailing underscore. Empty tables give empty results.
    """
    names = tuple(own_column(pages, n) for n in ("host", "path", "rule", "verdict", "rule_host_size"))
    host, path, rule, verdict, size = names
    out = pages.withColumns({host: url_host(F.col(url)), path: url_path(F.col(url))})
    empty = F.lit(None)
    out = out.withColumns(
        {rule: empty.cast("string"), verdict: empty.cast("string"), size: empty.cast("int")}
    )
    known = rules.select("host", "path", "verdict").dropna().distinct()
    blocks = max(1, -(-known.count() // rules_per_block))
    schema = T.StructType([*out.schema.fields])
    for block in range(blocks):
        # About rules_per_block rows by hash; both verdicts of one rule stay together.
        part = known.where(F.pmod(F.xxhash64("host", "path"), F.lit(blocks)) == block)
        tree = RuleTree([tuple(row) for row in part.collect()])
        if tree.keys:
            out = out.mapInArrow(_apply(tree, names), schema)
    return out.withColumn(verdict, F.coalesce(verdict, F.lit(default))).drop(size)
