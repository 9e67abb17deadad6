"""Connected components of a link table by alternating large and small stars.

Each round is two aggregations and two joins on the node id (partial minimum before the
shuffle, so a node with very many links is reduced map-side; its join is left to AQE's
skew split).  Rounds are written under ``spark.checkpoint.dir``: a lost executor re-reads
the last round instead of replaying all of them.  Nothing is gathered on the driver but
one row with the table's size and checksum.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Links that one task holds at a time while it reduces them to a forest.
CHUNK = 200_000


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node of its tree) of the links' components, roots left out."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(n, r) for n in list(parent) if (r := find(n)) != n]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []

    def out(links):
        u, v = zip(*links) if links else ((), ())
        return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for b in batches:
        held += zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        if len(held) >= CHUNK:
            yield out(forest(held))
            held = []
    yield out(forest(held))


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (two long columns); root: the smallest node.

    Repeated links, both directions and self-links are fine; rows with a null end link
    nothing.  A node whose only links are self-links is its own root and is left out, as
    are nodes without links.  An empty table gives an empty table.
    """
    a, b = links.columns
    edges = (links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
             .mapInArrow(_contract, "u long, v long").distinct())
    edges, mark = materialise(edges, "cc"), None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        edges = materialise(small, "cc")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if tuple(row) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(row)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
