"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Fingerprints are computed next to the scan (one Arrow pass, 16 bytes a document leave it).
All later steps work on *distinct* fingerprints, so a group of equal texts, however large,
is one row.

Candidates: the 64 bits are cut into ``blocks`` (7); two fingerprints that differ in at
most ``max_bits`` (4) agree on at least ``blocks - max_bits`` (3) whole blocks, so every
choice of 3 blocks is a join key (35 keys of 27 or 28 bits).  Keys held by one fingerprint
alone are dropped after a count with map-side combine.

* A key with up to ``DENSE`` fingerprints is verified inside its group: exact Hamming
  distances, and only a spanning forest of the links leaves the group.
* The fingerprints of larger groups (thousands of near copies that agree on most blocks)
  meet in the middle instead: two fingerprints within 4 bits share a value within 2 bits
  of each, so each is spread over its 2,081 such values, and a value held by several
  links each of them to the smallest.  Linear in the group, exact, no pairs.

Between them no link between different fingerprints is lost from the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fresh, materialise, words_of
from .components import connected_components

SEED = 42
#: Largest key group that is compared inside one task (2048 x 2048 distances, in rows).
DENSE = 2048


def fingerprint(text: str, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; 0 when it has no word."""
    words = words_of(text)
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return digest(joined(words), SEED)
    hashes = np.array([digest(joined(w), SEED)
                       for w in zip(*(words[i:] for i in range(shingle)))], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, column: str, shingle: int = 4) -> DataFrame:
    """``docs`` with the fingerprint of its text as a signed long; null and blank texts: zero."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py() or "", shingle) for t in b.column(at)], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``; fp is the fingerprint as a signed long.

    Rows stay rows: repeated ids and null ids are kept, other columns are ignored.  An empty
    table gives an empty table.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_fingerprint(own, "fp", shingle).select("doc_id", "fp")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """A bit mask for every choice of ``blocks - max_bits`` blocks, as signed longs."""
    edges = np.linspace(0, 64, blocks + 1).round().astype(int)
    parts = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_bits


def group_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links inside one group of distinct fingerprints."""
    rest, links = fps.view(np.uint64), []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            f, front = front[0], front[1:]
            near = _near(rest, f, max_bits)
            if near.any():
                found, rest = rest[near], rest[~near]
                links += [(int(x), int(f)) for x in found.view(np.int64)] \
                    if f < 1 << 63 else [(int(x), int(f) - (1 << 64)) for x in found.view(np.int64)]
                front = np.concatenate([front, found])
    return links


def near_values(max_bits: int) -> np.ndarray:
    """Masks of at most ``max_bits / 2`` set bits."""
    one = [1 << i for i in range(64)]
    return np.array([sum(c) for n in range(max_bits // 2 + 1) for c in combinations(one, n)], np.uint64)


def fingerprint_links(fps: DataFrame, max_bits: int = 4, blocks: int = 7,
                      dense: int = DENSE) -> DataFrame:
    """(a, b) links between distinct fingerprints that differ in at most ``max_bits`` bits.

    The links connect what all pairs within the distance would connect, and every one of
    them is such a pair.  ``max_bits`` must be even and below ``blocks``.
    """
    if max_bits % 2 or max_bits >= blocks:
        raise ValueError("max_bits must be even and smaller than blocks")
    keys = [F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m)))
            for t, m in enumerate(block_masks(blocks, max_bits))]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("k"))
    counts = materialise(keyed.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "simhash-keys")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            links = [x for g in b.column(0) for x in group_links(g.values.to_numpy(), max_bits)]
            yield pa.record_batch([pa.array([x[0] for x in links], pa.int64()),
                                   pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    groups = (keyed.join(counts.where(F.col("n") <= dense), "k")
              .groupBy("k").agg(F.collect_list("fp").alias("fps")).select("fps"))
    links = groups.mapInArrow(verify, "a long, b long").distinct()
    large = counts.where(F.col("n") > dense)
    if large.isEmpty():
        return links

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = near_values(max_bits)
        for b in batches:
            own = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(own), 64):
                part = own[at:at + 64]
                yield pa.record_batch([pa.array(np.repeat(part, len(masks)).view(np.int64)),
                                       pa.array((part[:, None] ^ masks).ravel().view(np.int64))],
                                      names=["fp", "v"])

    crowd = keyed.join(large, "k").select("fp").distinct().mapInArrow(spread, "fp long, v long")
    first = crowd.groupBy("v").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    met = (crowd.join(first, "v").where("fp <> b").select(F.col("fp").alias("a"), "b")
           .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct())
    return links.unionByName(met)


def _rooted(own: DataFrame, low: Column, max_bits: int, blocks: int) -> DataFrame:
    """(fp, low, root) for each distinct fingerprint of ``own``; low: that aggregate of its rows."""
    nodes = materialise(own.groupBy("fp").agg(low.alias("low")), "simhash-nodes")
    roots = connected_components(fingerprint_links(nodes.select("fp"), max_bits, blocks))
    return (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", "low", F.coalesce("root", "fp").alias("root")))


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                       blocks: int = 7) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest doc_id that links of at most ``max_bits`` bits reach, the
    document's own included.  Documents without a word have fingerprint zero and link like
    any other.  A null doc_id takes part in the links but names no component (a component
    of null ids alone has a null id); repeated rows stay repeated.
    """
    own = materialise(fingerprints(docs, shingle), "simhash-fp")
    rooted = _rooted(own, F.min("doc_id"), max_bits, blocks)
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lows, "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id.

    Null ids come last; of rows that share id and fingerprint any one stays.  The texts move
    once, to meet the kept (doc_id, fingerprint) pairs; no group of rows is gathered.
    """
    own = materialise(fingerprints(docs, shingle), "simhash-fp")
    rooted = _rooted(own, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")), max_bits, blocks)
    fp, nth, kept_id, kept_fp = fresh("fp"), fresh("nth"), fresh("id"), fresh("kept")
    kept = (rooted.groupBy("root").agg(F.min(F.struct("low", "fp")).alias("m"))
            .select(F.col("m.low.doc_id").alias(kept_id), F.col("m.fp").alias(kept_fp)))
    rows = with_fingerprint(docs, fp, shingle)
    rows = rows.join(kept, F.expr(f"doc_id <=> `{kept_id}` AND `{fp}` = `{kept_fp}`"), "left_semi")
    once = Window.partitionBy("doc_id", fp).orderBy(F.lit(0))
    return rows.withColumn(nth, F.row_number().over(once)).where(F.col(nth) == 1).select(*docs.columns)


def hex_digits(column: str) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
