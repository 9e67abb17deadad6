"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, for every length k, the polynomial hash of its first k code
points modulo two primes.  Two look-ups and a shift by a power of the base compare any two
spans, of one text or of two; a binary search over such comparisons gives the longest
common extension at any pair of places.  The fingerprint is the hash of the whole with the
length; the likeness of two fingerprinted texts is the share of the longer one that their
longest common prefix and suffix cover.  The shared part resumes after each difference: it
also counts every code point in a span of ``SPAN`` that the other text has as well.

To pair every document with the next one (descending doc_id, the last with the first),
rows are dealt to ranges of doc_id whose split points are approximate quantiles (a bounded
list); each range also gets a copy of the row that follows its last one.  Texts move once,
and a sorted sweep holds two documents at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: Ranges of doc_id for each shuffle partition; their number is never above MOST_RANGES.
RANGES_EACH, MOST_RANGES = 4, 8192
#: Parts of a range that one id, or rows without an id, fill (by the top four bits of the text's hash).
SALTS = 16
#: Code points of the shortest span between differences that counts as shared.
SPAN = 16


class Powers:
    """Powers of the bases, as far as a task has needed them."""

    def __init__(self, bases: tuple[int, ...] = BASES):
        self.bases, self.of = bases, [np.ones(1, np.int64) for _ in PRIMES]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.of[0]) <= n:
            for k, (p, b) in enumerate(zip(PRIMES, self.bases)):
                have = self.of[k]
                step = pow(b, len(have), p)
                self.of[k] = np.concatenate([have, have * step % p])
        return self.of


_POWERS = Powers()
_INVERSES = Powers(tuple(pow(b, -1, p) for p, b in zip(PRIMES, BASES)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class PrefixHash:
    """Prefix arrays of one text: ``at[k][i]`` hashes its first i code points modulo prime k."""

    def __init__(self, at: list[np.ndarray]):
        self.at, self.n = at, len(at[0]) - 1
        self._spans: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> PrefixHash:
        return cls([np.zeros(1, np.int64) for _ in PRIMES]).extended(0, points)

    def extended(self, n: int, points: np.ndarray) -> PrefixHash:
        """The arrays of this text's first n code points followed by ``points``."""
        powers = _POWERS.upto(n + len(points))
        out = []
        for k, p in enumerate(PRIMES):
            more = np.cumsum((points + 1) * powers[k][n:n + len(points)] % p)
            out.append(np.concatenate([self.at[k][:n + 1], (more + self.at[k][n]) % p]))
        return PrefixHash(out)

    def same(self, i: int, other: PrefixHash, j: int, length: int) -> bool:
        """Whether the spans of ``length`` at i here and at j in ``other`` are equal."""
        powers = _POWERS.upto(max(i, j))
        for k, p in enumerate(PRIMES):
            a = (int(self.at[k][i + length]) - int(self.at[k][i])) * int(powers[k][j])
            b = (int(other.at[k][j + length]) - int(other.at[k][j])) * int(powers[k][i])
            if (a - b) % p:
                return False
        return True

    def common_extension(self, i: int, other: PrefixHash, j: int) -> int:
        """Longest length whose spans at i here and at j in ``other`` are equal."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(i, other, j, mid) else (low, mid - 1)
        return low

    def common_suffix(self, other: PrefixHash) -> int:
        low, high = 0, min(self.n, other.n)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(self.n - mid, other, other.n - mid, mid) else (low, mid - 1)
        return low

    def ends(self, other: PrefixHash) -> tuple[int, int]:
        """Lengths of the common prefix and of the common suffix behind it."""
        head = self.common_extension(0, other, 0)
        return head, min(self.common_suffix(other), min(self.n, other.n) - head)

    def likeness(self, other: PrefixHash) -> float:
        """Share of the longer text in the common prefix and suffix; two empty texts: 1."""
        return sum(self.ends(other)) / max(self.n, other.n) if max(self.n, other.n) else 1.0

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, starts) of all spans of ``SPAN`` code points, ordered by hash."""
        if self._spans is None:
            n, keys = max(0, self.n - SPAN + 1), np.int64(0)
            inverses = _INVERSES.upto(n)
            for a, p, inverse in zip(self.at, PRIMES, inverses):
                keys = (keys << 31) + (a[SPAN:] - a[:n]) % p * inverse[:n] % p if n else np.zeros(0, np.int64)
            order = np.argsort(keys)
            self._spans = keys[order], order
        return self._spans

    def covered(self, other: PrefixHash, head: int, tail: int) -> int:
        """Code points here in the first ``head``, the last ``tail`` or a span that ``other`` has."""
        (keys, starts), (theirs, _) = self.spans(), other.spans()
        if len(theirs):
            starts = starts[theirs[np.searchsorted(theirs, keys).clip(max=len(theirs) - 1)] == keys]
        else:
            starts = starts[:0]
        change = np.zeros(self.n + 1, np.int64)
        change[starts] += 1
        change[starts + SPAN] -= 1
        inside = np.cumsum(change)[:self.n] > 0
        inside[:head] = inside[self.n - tail:] = True
        return int(inside.sum())

    def compare(self, other: PrefixHash) -> tuple[float, float]:
        """(likeness, shared part): shared is what spans, prefix and suffix cover, in the text
        of which they cover less, as a share of the longer text; two empty texts: 1."""
        short, longer = sorted((self.n, other.n))
        if not longer:
            return 1.0, 1.0
        head, tail = self.ends(other)
        if head + tail == short:
            return short / longer, short / longer
        both = min(self.covered(other, head, tail), other.covered(self, head, tail))
        return (head + tail) / longer, both / longer

    def fingerprint(self) -> str:
        return f"{self.n:x}-" + "".join(f"{int(a[-1]):08x}" for a in self.at)


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compare(doc_id, text: str, points: np.ndarray, own: PrefixHash, next_text: str, next_hash: PrefixHash) -> tuple:
    half = len(points) // 2
    kept, given = text[:len(points) - half], next_text[:half]
    edited = own.extended(len(points) - half, code_points(given))
    digest = hashlib.sha256((kept + given).encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(points), digest, own.fingerprint(), edited.fingerprint(),
            own.compare(edited)[1], own.compare(next_hash)[1])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, at = None, None
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            out = []
            b = batch.slice(start, 256)
            for bucket, guest, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text"))):
                points = code_points(text)
                own = PrefixHash.of(points)
                if held is not None and bucket == at:
                    out.append(_compare(*held, text, own))
                # A second copy of the guest row follows nothing: the bucket is done.
                held = None if guest else (doc_id, text, points, own)
                at = bucket
            cols = list(zip(*out)) if out else [()] * len(_NAMES)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, _KINDS)], names=_NAMES)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next); near:
    the shared part, which goes on behind each difference.

    The edited text: the last floor(n / 2) code points replaced by the first as many (or
    all) of the next document in descending doc_id; after the last comes the first, and a
    lone document is its own next.  Null texts count as empty.  Repeated ids are ordered by
    their text's hash, rows without an id come last; both stay in the result.  Other columns
    are ignored; an empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Ids stay integers: pandas would turn a column with a null in it into floats.
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("id", F.coalesce("doc_id", F.lit(0)))
    ranges = min(MOST_RANGES, RANGES_EACH * shuffle_partitions(docs.sparkSession))
    probes = [i / ranges for i in range(1, ranges)]
    found = [int(x) for x in docs.select(F.col("doc_id").cast("double")).approxQuantile("doc_id", probes, 0.5 / ranges)]
    splits = np.array(sorted(set(found)), np.int64)
    hot = np.array([found.count(x) > 1 for x in splits.tolist()], bool)

    @F.pandas_udf("int")
    def bucket_of(id_: pd.Series, tie: pd.Series) -> pd.Series:
        """Ranges in descending order of id; an id that fills whole ranges has one of its own,
        cut by the text's hash."""
        ids, part = id_.to_numpy(np.int64), (tie.to_numpy(np.int64) >> 60) + SALTS // 2
        at = np.searchsorted(splits, ids, side="right")
        own = (at > 0) & (hot[at - 1] & (splits[at - 1] == ids) if len(splits) else False)
        return pd.Series((2 * (len(splits) - at) + own) * SALTS + np.where(own, part, 0)).astype("int32")

    last = (2 * len(splits) + 2) * SALTS + SALTS // 2 + F.shiftright("tie", 60)
    own = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), last.cast("int")).otherwise(bucket_of("id", "tie")))
    # One row for each range: the first in sweep order.
    order = F.struct(F.col("doc_id").isNull(), F.bitwise_not("id"), F.col("tie"))
    firsts = sorted(((r.bucket, r.doc_id, r.tie) for r in own.groupBy("bucket").agg(
        F.min_by("doc_id", order).alias("doc_id"), F.min_by("tie", order).alias("tie")).collect()), key=lambda r: r[0])
    if not firsts:
        return docs.sparkSession.createDataFrame([], _OUT)
    targets = {(d is None, d or 0, t): firsts[i - 1][0] for i, (_, d, t) in enumerate(firsts)}
    known = docs.sparkSession.sparkContext.broadcast(targets)

    @F.pandas_udf("int")
    def guest_of(none: pd.Series, id_: pd.Series, tie: pd.Series) -> pd.Series:
        keys = zip(none.tolist(), id_.tolist(), tie.tolist())
        return pd.Series([known.value.get(k) for k in keys], dtype="Int32")

    both = own.withColumn("target", guest_of(F.col("doc_id").isNull(), "id", "tie")).withColumn("to", F.explode(F.when(
        F.col("target").isNull(), F.array(F.struct(F.col("bucket"), F.lit(0).alias("guest")))).otherwise(
        F.array(F.struct(F.col("bucket"), F.lit(0).alias("guest")), F.struct(F.col("target").alias("bucket"), F.lit(1).alias("guest"))))))
    dealt = (both.select("to.bucket", "to.guest", "doc_id", "tie", "text")
             .repartition(shuffle_partitions(docs.sparkSession), "bucket")
             .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "tie"))
    return dealt.mapInArrow(_sweep, _OUT)
