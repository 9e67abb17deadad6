"""URL block and allow rules by a sort-merge range join on reversed-host keys.

A host is written back to front, label by label, each label closed by 0x01:
``m.example.net`` becomes ``net|example|m|``.  A rule's host prefix is then an interval of
keys, and the intervals of all rules are nested or disjoint.  URLs and rules are dealt to
the same key ranges (split points from a bounded sample; they balance the work and cannot
change the result), a rule to every range that its interval meets.  Inside a range, sorted,
one sweep keeps the stack of open rule hosts; the path part is looked up by the prefix
lengths that the open rules have.  A split point that repeats marks a very frequent key,
whose rows are dealt over all the ranges between its copies.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, shuffle_partitions

#: The rule set of the registered query: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Keys sampled for each range when split points are chosen.
SAMPLE_PER_RANGE = 20
_OUT = "page_id long, host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host from the first ``://`` to ``/ ? #`` or the end, A-Z in lower case;
    path from there to ``? #`` or the end.  Null or no ``://``: both empty."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for c in "?#" if (i := path.find(c)) >= 0), default=len(path))
    return rest[:end].translate(ASCII_LOWER), path[:stop]


def host_key(host: str) -> str:
    return "".join(label + "\x01" for label in reversed(host.split(".")))


def key_end(key: str) -> str:
    """The first key after all keys that begin with ``key``."""
    return key[:-1] + "\x02"


def range_of(key: str, salt: int, splits: list[str]) -> int:
    low, high = bisect_left(splits, key), bisect_right(splits, key)
    return low + salt % (high - low + 1)


class Sweep:
    """The stack of open rule hosts while keys go up."""

    def __init__(self):
        self.open: list[tuple[str, str, dict[str, str], list[int]]] = []  # host, end, verdict by path, lengths

    def reach(self, key: str) -> None:
        while self.open and self.open[-1][1] <= key:
            self.open.pop()

    def rule(self, host: str, path: str, verdict: str) -> None:
        if not self.open or self.open[-1][0] != host:
            self.open.append((host, key_end(host_key(host)), {}, []))
        _, _, paths, lengths = self.open[-1]
        if paths.get(path) != "block":
            paths[path] = verdict
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, host: str, path: str) -> tuple[str | None, str | None]:
        best = (-1, "", None)
        for own, _, paths, lengths in reversed(self.open):
            if host != own and not host.endswith("." + own):
                continue
            n = next((n for n in lengths if n <= len(path) and path[:n] in paths), None)
            if n is not None and len(own) + n > best[0]:
                best = (len(own) + n, own + path[:n], paths[path[:n]])
        return best[1] or None, best[2]


def judge_pages(pages: DataFrame, rules: DataFrame, default: str = "allow",
                ranges: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    ``rules``: (verdict, host, path).  A rule fits its host and all subdomains when the
    url's path begins with the rule's; the longest (host and path together) wins, then the
    longer host, then block.  Rule rows with a null or an empty host fit nothing.  Urls that
    no rule fits get ``default`` and a null rule, as do null urls and urls without ``://``.
    Repeated pages stay repeated; a null page_id is kept; other columns are ignored.
    """
    spark = pages.sparkSession
    n = ranges or shuffle_partitions(spark)

    def key_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [split_url(u) for u in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([p[0] for p in parts], pa.string()),
                                   pa.array([p[1] for p in parts], pa.string()),
                                   pa.array([host_key(p[0]) + "\x00" + p[1] for p in parts], pa.string())],
                                  names=["page_id", "host", "path", "key"])

    keyed = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
             .mapInArrow(key_pages, "page_id long, host string, path string, key string"))
    sample = sorted(r[0] for r in keyed.orderBy(F.xxhash64("page_id", "key"))
                    .limit(SAMPLE_PER_RANGE * n).select("key").collect())
    splits = [sample[len(sample) * i // n] for i in range(1, n)] if sample else []

    def deal_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for b in batches:
            at = []
            for key in b.column("key").to_pylist():
                nth += 1
                at.append(range_of(key, nth, splits))
            yield pa.record_batch([pa.array(at, pa.int32()), b.column("key"), pa.array([1] * len(at), pa.int32()),
                                   b.column("page_id"), b.column("host"), b.column("path"),
                                   pa.nulls(len(at), pa.string())], names=names)

    def deal_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for verdict, host, path in zip(*(c.to_pylist() for c in b.columns)):
                key = host_key(host)
                for r in range(bisect_left(splits, key), bisect_right(splits, key_end(key)) + 1):
                    out.append((r, key, 0, None, host, path, verdict))
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    names = ["range", "key", "kind", "page_id", "host", "path", "verdict"]
    types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()]
    schema = "range int, key string, kind int, page_id long, host string, path string, verdict string"
    good = (rules.select("verdict", F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
                         .alias("host"), "path").dropna().where("host <> ''"))
    events = keyed.mapInArrow(deal_pages, schema).unionByName(good.mapInArrow(deal_rules, schema))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, Sweep()
        for b in batches:
            out = []
            for r, key, kind, page_id, host, path, verdict in zip(*(c.to_pylist() for c in b.columns)):
                if r != at:
                    at, state = r, Sweep()
                state.reach(key)
                if kind == 0:
                    state.rule(host, path, verdict)
                else:
                    rule, found = state.judge(host, path)
                    out.append((page_id, host, path, rule, found or default))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), *[pa.string()] * 4))],
                                  names=["page_id", "host", "path", "rule", "verdict"])

    dealt = events.repartition(n, "range").sortWithinPartitions("range", "key", "kind", "host", "path")
    return dealt.mapInArrow(sweep, _OUT)
