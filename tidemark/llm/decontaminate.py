"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of 64 words, half overlapping.  Their terms are hashed to ``SLOTS``
places; inverse frequencies come from all documents (one aggregation with map-side sums,
a result of at most ``SLOTS`` rows).  A distributed randomised SVD of the benchmark's
TF-IDF passages gives the latent space: tasks push a random basis through their passages,
their products are summed by slot and column in a shuffle, and only the basis (bounded by
``SLOTS`` times the rank) is orthogonalised on the driver.

Documents are folded into that space block by block next to the scan: each window takes
the inner products with all benchmark items; windows whose cosine and whose share of the
item's weight are high enough are candidates.  A candidate is aligned to the item by the
commonest offset of equal words and checked by the longest common subsequence, and the
item's answer (its last sentence when there is no answer column) must be there as well.
Benchmark items are sent out in blocks of about ``BLOCK``; more items mean more passes, so
what is broadcast stays bounded.  Documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, words_of
from .lm import split_words

SLOTS = 1 << 16
RANK = 128
OVERSAMPLE = 16
HALF = 32
#: A window is a candidate from this cosine on ...
COSINE = 0.4
#: ... and with this share of the item's weight.
SHARE = 0.3
#: Least share of the item's words in the longest common subsequence.
LCS = 0.6
#: Least share of the answer's words found in order.
ANSWER = 0.5
#: Benchmark items in one broadcast, about.
BLOCK = 4096
#: Words a task remembers the term of, at most.
REMEMBERED = 250_000
_EDGE = ".,;:!?\"'()[]{}«»„“”‘’…-–—*"


class Terms:
    """Words to 64-bit terms: full lower case, punctuation at the edges off."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        return self._look_up(words_of(text or ""))

    def of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(terms, ends): text i has the terms[ends[i - 1]:ends[i]]; each distinct word is looked up once."""
        codes, ends, distinct = split_words(texts)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct), b" ")
        return self._look_up(joined[0].as_py().split())[codes], ends

    def _look_up(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        found = list(map(known.get, words))
        for i in [i for i, t in enumerate(found) if t is None]:
            w = words[i]
            if w.isalnum():  # ASCII letters and digits, lower case already: nothing to take off
                known[w] = found[i] = xxhash.xxh64_intdigest(w)
            else:
                s = w.decode("utf-8", "replace").lower()
                known[w] = found[i] = xxhash.xxh64_intdigest((s.strip(_EDGE) or s).encode())
        return np.fromiter(found, np.uint64, len(found))


def slots_of(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(48)).astype(np.int64) % SLOTS


def blocks_of(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log(1 + blocks / blocks with the slot), over all blocks of 32 words of all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total, found = Terms(), 0, np.zeros(SLOTS, np.int64)
        for b in blocks_of(batches):
            slots, ends = terms.of_all(b.column(0))
            slots, lens = slots_of(slots), np.diff(ends, prepend=0)
            blocks = -(-lens // HALF)
            # A row for each block; what a text's last block lacks is SLOTS, which is not counted.
            held = np.full(blocks.sum() * HALF, SLOTS, np.int32)
            shift = np.cumsum(blocks) * HALF - blocks * HALF - (ends - lens)
            held[np.arange(len(slots)) + np.repeat(shift, lens)] = slots
            held = np.sort(held.reshape(-1, HALF), axis=1)
            new = held < SLOTS
            new[:, 1:] &= held[:, 1:] != held[:, :-1]
            found += np.bincount(held[new], minlength=SLOTS)
            total += int(blocks.sum())
        at = np.flatnonzero(found)
        yield pa.record_batch([pa.array(np.r_[at, -1].astype(np.int32)), pa.array(np.r_[found[at], total])],
                              names=["slot", "n"])

    rows = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    got = rows.toArrow()  # at most SLOTS + 1 rows
    n = np.zeros(SLOTS + 1)
    n[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return np.log1p((n[-1] + 1) / (n[:-1] + 1))


def passages(terms: np.ndarray, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, unit TF-IDF weights) of a benchmark item's windows."""
    out = []
    for at in range(0, max(1, len(terms) - HALF), HALF):
        slots, tf = np.unique(slots_of(terms[at:at + 2 * HALF]), return_counts=True)
        w = tf * idf[slots]
        if len(slots):
            out.append((slots, w / max(np.linalg.norm(w), 1e-12)))
    return out


def latent_basis(benchmark: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(slots, basis): the leading right singular vectors of the benchmark's TF-IDF passages.

    Two distributed passes of A'A over a random block; slots that no passage holds are left out.
    """
    width = rank + OVERSAMPLE
    shared = benchmark.sparkSession.sparkContext.broadcast(idf)

    def product(slots: np.ndarray | None, basis: np.ndarray | None):
        """Sum of a'(a basis) over the passages a: {(slot, column): value}."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if basis is None:
                full = np.random.default_rng(seed).standard_normal((SLOTS, width))
            else:
                full = np.zeros((SLOTS, width))
                full[slots] = basis
            out, used, terms = np.zeros((SLOTS, width)), np.zeros(SLOTS, bool), Terms()
            for b in blocks_of(batches):
                for text in b.column(0).to_pylist():
                    for s, w in passages(terms.of(text), shared.value):
                        out[s] += w[:, None] * (w @ full[s])
                        used[s] = True
            at = np.flatnonzero(used)
            for i in range(0, len(at), 512):
                part = at[i:i + 512]
                yield pa.record_batch([pa.array(np.repeat(part, width).astype(np.int32)),
                                       pa.array(np.tile(np.arange(width, dtype=np.int32), len(part))),
                                       pa.array(out[part].ravel())], names=["slot", "j", "v"])

        rows = (benchmark.select("text").mapInArrow(run, "slot int, j int, v double")
                .groupBy("slot", "j").agg(F.sum("v").alias("v")))
        got = rows.toArrow()  # at most SLOTS * width rows, whatever the benchmark's size
        found, at = np.unique(got.column("slot").to_numpy(), return_inverse=True)
        z = np.zeros((len(found), width))
        z[at, got.column("j").to_numpy()] = got.column("v").to_numpy()
        return found, z

    slots, z = product(None, None)
    if not len(slots):
        return slots, np.zeros((0, 0))
    q = np.linalg.qr(z)[0]
    if q.shape[1] < width:
        q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
    _, z = product(slots, q)
    values, vectors = np.linalg.eigh(q.T @ z)
    keep = np.argsort(-values)[:rank]
    keep = keep[values[keep] > 1e-9 * max(values.max(), 1e-30)]
    return slots, q @ vectors[:, keep]


def last_sentence(text: str) -> str:
    """The last sentence of three words or more; else the last quarter of the words."""
    for part in reversed(re.split(r"(?<=[.!?])\s+|\n+", text.strip())):
        if len(part.split()) >= 3:
            return part
    words = text.split()
    return " ".join(words[-max(1, len(words) // 4):])


def common_subsequence(masks: dict[int, int], n: int, terms: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's n terms."""
    full = (1 << n) - 1
    v = full
    for t in terms:
        m = masks.get(t)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def bit_masks(terms: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, t in enumerate(terms):
        out[t] = out.get(t, 0) | 1 << i
    return out


class Finder:
    """One block of benchmark items in the latent space."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], slots: np.ndarray, basis: np.ndarray,
                 idf: np.ndarray):
        self.items = [(i, t, a) for i, t, a in items if len(t)]
        self.place = np.full(SLOTS, -1, np.int32)
        self.place[slots] = np.arange(len(slots))
        self.rows = (idf[slots][:, None] * basis).astype(np.float32)
        query, self.owner = [], []
        for n, (_, terms, _) in enumerate(self.items):
            # A long item is searched by its windows, so that a window of a text can match one.
            for at in range(0, max(1, len(terms) - HALF), HALF):
                query.append(self._fold(terms[at:at + 2 * HALF]))
                self.owner.append((n, at))
        self.query = np.array(query, np.float32).reshape(len(query), self.rows.shape[1])
        self.weight = (self.query ** 2).sum(1)
        self.checks = [(bit_masks(t.tolist()), bit_masks(a.tolist()), len(a)) for _, t, a in self.items]

    def _fold(self, terms: np.ndarray) -> np.ndarray:
        at = self.place[slots_of(terms)]
        return self.rows[at[at >= 0]].sum(0)

    def candidates(self, terms: np.ndarray) -> Iterator[tuple[int, int, float, float]]:
        """(item, text window's first word, offset in the item, cosine) above both bounds."""
        step = 1024 * HALF
        for base in range(0, len(terms), step):
            part = terms[base:base + step + HALF]
            at = self.place[slots_of(part)]
            hit = np.flatnonzero(at >= 0)
            if not len(hit):
                continue
            block, first = np.unique(hit // HALF, return_index=True)
            sums = np.zeros((-(-len(part) // HALF), self.rows.shape[1]), np.float32)
            sums[block] = np.add.reduceat(self.rows[at[hit]], first)
            if len(sums) > 1:
                sums = sums[:-1] + sums[1:]
            dots = sums @ self.query.T
            rows, cols = np.nonzero(dots >= SHARE * self.weight)
            if not len(rows):
                continue
            dots, norms = dots[rows, cols], np.sqrt((sums ** 2).sum(1)[rows] * self.weight[cols]) + 1e-9
            near = np.flatnonzero(dots >= COSINE * norms)
            for r, c, cosine in zip(rows[near].tolist(), cols[near].tolist(), (dots[near] / norms[near]).tolist()):
                n, offset = self.owner[c]
                yield n, base + r * HALF, offset, cosine

    def verify(self, n: int, at: int, offset: int, terms: np.ndarray) -> tuple[int, int, float, float] | None:
        """(first word, words, LCS share, answer share) when the window holds the item."""
        _, item, answer = self.items[n]
        low = max(0, at - offset - len(item))
        span = terms[low:at + 2 * HALF + len(item)]
        if len(item) * len(span) <= 1 << 22:
            equal = span[:, None] == item[None, :]
            # A common subsequence takes each of the item's words once at most.
            if np.count_nonzero(equal.any(0)) < LCS * len(item):
                return None
            i, j = np.nonzero(equal)
        else:
            i, j = self._pairs(span, item)
            if len(i) < LCS * len(item):
                return None
        slack = max(1, len(item) // 8)
        start = np.bincount(i - j + len(item))
        near = np.convolve(start, np.ones(2 * slack + 1), "same")
        first = max(0, int(near.argmax()) - len(item) - 2 * slack)
        part = span[first:first + len(item) + 4 * slack]
        masks, answers, n_answer = self.checks[n]
        listed = part.tolist()
        share = common_subsequence(masks, len(item), listed) / len(item)
        if share < LCS:
            return None
        right = common_subsequence(answers, n_answer, listed) / n_answer if n_answer else 1.0
        if right < ANSWER:
            return None
        return low + first, len(part), share, right

    @staticmethod
    def _pairs(span: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal places of two long sequences, each term's first place in the item only."""
        terms, first = np.unique(item, return_index=True)
        at = np.searchsorted(terms, span).clip(max=len(terms) - 1)
        i = np.flatnonzero(terms[at] == span)
        return i, first[at[i]]

    def find(self, terms: np.ndarray) -> list[tuple]:
        """(item_id, first word, words, cosine, LCS share, answer share), one an item."""
        by: dict[int, list] = {}
        for n, at, offset, cosine in self.candidates(terms):
            by.setdefault(n, []).append((-cosine, at, offset))
        out = []
        for n, windows in sorted(by.items()):
            for cosine, at, offset in sorted(windows):
                if found := self.verify(n, at, offset, terms):
                    out.append((self.items[n][0], found[0], found[1], -cosine, found[2], found[3]))
                    break
        return out


def prepare(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """Broadcasts of one :class:`Finder` for each block of items (about ``BLOCK`` items)."""
    spark = docs.sparkSession
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = materialise(benchmark.where("item_id IS NOT NULL")
                        .select(F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer"))
                        .distinct(), "benchmark")
    blocks = -(-items.count() // BLOCK)
    if not blocks:
        return
    idf = inverse_frequencies(docs)
    slots, basis = latent_basis(items, idf)
    terms = Terms()
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        own = [(r.item_id, terms.of(r.text),
                terms.of(r.answer if r.answer is not None else last_sentence(r.text or ""))) for r in rows]
        yield spark.sparkContext.broadcast(Finder(own, slots, basis, idf))


_HIT = ("doc_id long, item_id long, first_word long, n_words long, cosine double, lcs_share double, "
        "answer_share double")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, cosine, lcs_share, answer_share), one row for
    each item that a row of ``docs`` holds.

    Null and empty texts hold nothing, items without words are in no text, an item without
    an id is not looked for.  Repeated rows give repeated hits; a null doc_id is kept; other
    columns are ignored.  Empty tables give an empty table.
    """
    own, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for finder in prepare(own, benchmark):
        def run(batches: Iterator[pa.RecordBatch], finder=finder) -> Iterator[pa.RecordBatch]:
            terms, find = Terms(), finder.value.find
            for b in blocks_of(batches):
                found, ends = terms.of_all(b.column(1))
                rows = [(d, *h) for d, t in zip(b.column(0).to_pylist(), np.split(found, ends[:-1])) for h in find(t)]
                cols = list(zip(*rows)) if rows else [()] * 7
                kinds = [pa.int64()] * 4 + [pa.float64()] * 3
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["doc_id", "item_id", "first_word", "n_words", "cosine", "lcs_share", "answer_share"])
        hits = own.mapInArrow(run, _HIT)
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else own.sparkSession.createDataFrame([], _HIT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns unchanged."""
    at, out = docs.columns.index("text"), docs
    for finder in prepare(docs, benchmark):
        def run(batches: Iterator[pa.RecordBatch], finder=finder) -> Iterator[pa.RecordBatch]:
            terms, find = Terms(), finder.value.find
            for b in blocks_of(batches):
                found, ends = terms.of_all(b.column(at))
                clean = [not find(t) for t in np.split(found, ends[:-1])]
                yield b.filter(pa.array(clean, pa.bool_()))
        out = out.mapInArrow(run, docs.schema)
    return out
