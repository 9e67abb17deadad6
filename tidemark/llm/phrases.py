"""Phrase collocations by dynamic itemset counting.

The corpus is cut once into ``shards`` parts of numbered words, which are scanned in a cycle.  Words are
counted from the first step on; a longer phrase becomes active in the step after both its
subphrases (without its last, without its first word) have been seen ``least`` times so far,
is counted from there on and is complete when it has met every shard once.  So several lengths are
counted in one scan, and the scans end when no phrase is under way.  No phrase that occurs
``least`` times can be missed: its subphrases occur at least as often.

While the cycle runs, phrases are counted by hash slot: tasks sort the slots they meet and hand their
counts on in blocks of slots, so no process holds all slots and their number follows the text.  A slot that
has reached the threshold is known to all and counted no further.  What all must know are the steps in which slots
reached the threshold; few do, so those are kept in two small tables under two hashes of the slot (:class:`Known`).
A slot's count is at least that of any phrase in it, and the tables forget none, so a phrase
can become active too early, never too late.  After the last cycle, phrases of slots below the threshold
are known to be too rare; one more scan counts all others by their text, which is exact.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.incremental import delete_folder
from ..session import scratch_path
from .common import UPPER, materialise, shuffle_partitions

LEAST, LONGEST, SHARDS = 30, 4, 4
#: Hash slots: one for so many bytes of text, a power of two between these bounds (they set the cost, not the result).
SLOT_BYTES, FEWEST, MOST = 16, 1 << 20, 1 << 31
#: Slots for an entry of each table of known ones, and the most entries of one (they set the cost, not the result).
KNOWN_SLOTS, MOST_KNOWN = 8, 1 << 25
#: Slots of a block of counts.
SPAN = 1 << 18
#: A longer phrase that holds so many of 100 occurrences replaces a candidate; best phrases a language.
COVERED, BEST = 80, 2000
#: Bytes of text that are numbered and counted at a time.
BLOCK = 2 << 20
#: Bytes of text that one task scans, unless cores would idle: what it finds more than once it sends once.
TASK_BYTES = 24 << 20
#: The same for the last scan, whose tasks send most of their phrases.
LAST_BYTES = 64 << 20
#: Bytes of a block's counts from which they are packed.
PACKED = 1 << 12
#: Slots that a task sorts at a time, and bytes of blocks that it sends at a time.
SORTED, SENT = 1 << 23, 1 << 20
#: Parts that a hot word's row is copied to, and into which each language is ranked first.
SALTS = 16
UNSET = 255

_CUTS = bytes(b".,;:!?\x0a\x0b\x0c\x0d")
#: A-Z to lower case, every cut to a full stop, tab to space.
_TABLE = bytes.maketrans(UPPER.encode() + _CUTS + b"\t", UPPER.lower().encode() + b"." * len(_CUTS) + b" ")

_COUNTS = "lang string, k int, phrase string, n long"
_SKETCH = "block int, counts binary"
_ADDED = "block int, counts binary, full binary"
_BLOCKS = "shard int, lang string, vocabulary binary, hashes binary, words binary"


def words_and_cuts(text: bytes) -> list[bytes]:
    """The words of a text, with ``b'.'`` between its pieces."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


def _mixed(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Hashes of phrases of k words from those of their two subphrases."""
    with np.errstate(over="ignore"):
        h = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k)
        return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def numbered(lang: str, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, the number of each word or cut in turn, hashes by number); the cut is number 0."""
    words = words_and_cuts(b".".join(texts) + b".")
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    number[b"."]
    at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    prefix = lang.encode() + b"\0"
    hashes = np.fromiter((xxhash.xxh64_intdigest(prefix + w) for w in number), np.uint64, len(number))
    return list(number), at, hashes


def _number(hashes: np.ndarray) -> type:
    """What holds the numbers of a block's words."""
    return np.uint16 if len(hashes) <= 1 << 16 else np.int32


def _numbers(hashes: bytes, words: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A block's (word numbers in turn, hashes by number), as stored by :func:`_cut`."""
    hashes = np.frombuffer(hashes, np.uint64)
    return np.frombuffer(words, _number(hashes)), hashes


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language at a time, about ``BLOCK`` bytes of all languages together."""
    held, size = defaultdict(list), 0
    for b in batches:
        for start in range(0, b.num_rows, 256):
            part = b.slice(start, 256)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                held[lang].append(text)
                size += len(text) + 1
                if size >= BLOCK:
                    yield from held.items()
                    held, size = defaultdict(list), 0
    yield from held.items()


def _cut(shards: int):
    """Texts as numbered words, dealt to shards block by block; a part of a table always gives the same blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, (lang, texts) in enumerate(by_language(batches)):
            distinct, at, hashes = numbered(lang, texts)
            yield pa.record_batch([
                pa.array([(part + n) % shards], pa.int32()), pa.array([lang], pa.string()), pa.array([b" ".join(distinct)], pa.binary()),
                pa.array([hashes.tobytes()], pa.binary()), pa.array([at.astype(_number(hashes)).tobytes()], pa.binary())],
                names=[c.split()[0] for c in _BLOCKS.split(", ")])
    return run


class Level(NamedTuple):
    """The distinct phrases of one length in a block: slot, step in which that was reached, first
    step, count and first place of each."""

    k: int
    slots: np.ndarray
    reached: np.ndarray
    act: np.ndarray
    counts: np.ndarray
    first: np.ndarray


class Known:
    """The steps in which slots reached the threshold: those of a slot's entries in two tables, the later one.

    An entry keeps the first step in which one of its slots did.  So a slot that others share both
    entries with can seem to have reached the threshold, from one step on and for good, and none that has is
    missed.  Slots of phrases that can't be subphrases have halves of the tables for themselves.
    """

    def __init__(self, slots: int, packed: bytes | None = None):
        if packed is None:
            both = np.full(2 * max(1 << 16, min(slots // KNOWN_SLOTS, MOST_KNOWN)), UNSET, np.uint8)
        else:
            both = np.frombuffer(zlib.decompress(packed), np.uint8)
        self.slots, self.half, self.tables = slots, len(both) // 4, both.reshape(2, -1)

    def __len__(self) -> int:
        return self.slots

    def _entries(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = (2 * slots >= self.slots) * self.half
        with np.errstate(over="ignore"):
            mixed = (slots.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - self.half.bit_length())
        return (slots & (self.half - 1)) + own, mixed.astype(np.int64) + own

    def __getitem__(self, slots: np.ndarray) -> np.ndarray:
        first, second = self._entries(slots)
        return np.maximum(self.tables[0][first], self.tables[1][second])

    def add(self, slots: np.ndarray, step: int) -> bool:
        """Whether that is news about phrases that can be subphrases."""
        news = False
        for table, entries in zip(self.tables, self._entries(slots)):
            entries = entries[table[entries] == UNSET]
            table[entries] = step
            news |= bool((entries < self.half).any())
        return news

    def packed(self) -> bytes:
        return zlib.compress(self.tables.tobytes(), 1)


#: What this process has unpacked last.
_unpacked: dict[str, Known] = {}


def _known(name: str, slots: int, packed) -> Known:
    if name not in _unpacked:
        _unpacked.clear()
        _unpacked[name] = Known(slots, packed.value)
    return _unpacked[name]


def _slots(hashes: np.ndarray, k: int, slots: int, longest: int) -> np.ndarray:
    """The slots of phrases of k words; those that can't be subphrases have a half for themselves."""
    return (hashes >> np.uint64(65 - (slots - 1).bit_length())).astype(np.int64) + (k == longest) * (slots // 2)


def levels(at: np.ndarray, hashes: np.ndarray, reached: np.ndarray | Known, longest: int) -> Iterator[Level]:
    """Phrases of numbered words whose subphrases have reached the threshold, length by length."""
    def state(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        slots = _slots(hashes, k, len(reached), longest)
        return slots, reached[slots].astype(np.int32)

    slots, steps = state(hashes, 1)
    steps[0] = UNSET  # the cut
    act = np.zeros(len(slots), np.int32)
    yield Level(1, slots, steps, act, np.bincount(at, minlength=len(hashes)), np.zeros(0, np.int64))
    # here[i]: number of the phrase of k - 1 words that begins at word i, if it has reached the threshold
    here = np.where(steps[at] != UNSET, at, -1)
    for k in range(2, longest + 1):
        places = np.flatnonzero((here[:-1] >= 0) & (here[1:] >= 0))
        if not len(places):
            return
        code, own = pd.factorize(here[places] * np.int64(len(hashes)) + here[places + 1])
        left, right = own // len(hashes), own % len(hashes)
        # Others may have filled a subphrase's slot before it was active; no phrase begins before its subphrases.
        act = np.maximum(1 + np.maximum(steps[left], steps[right]), np.maximum(act[left], act[right]))
        hashes = _mixed(hashes[left], hashes[right], k)
        slots, steps = state(hashes, k)
        first = np.empty(len(own), np.int64)
        first[code[::-1]] = places[::-1]
        yield Level(k, slots, steps, act, np.bincount(code, minlength=len(own)), first)
        here = np.full(len(at), -1, np.int64)
        here[places] = np.where(steps[code] != UNSET, code, -1)


def under_way(at: np.ndarray, hashes: np.ndarray, reached: np.ndarray | Known, step: int, shards: int, longest: int
              ) -> Iterator[np.ndarray]:
    """Slots below the threshold of the active, incomplete phrases of a block, length by length, one
    for each occurrence.

    The same phrases as in :func:`levels`, place by place: nothing is grouped.
    """
    slots = _slots(hashes, 1, len(reached), longest)
    steps = reached[slots]
    if step < shards:
        few = steps == UNSET
        few[0] = False  # the cut
        yield slots[at[few[at]]]
    steps[0] = UNSET
    # Places at which a phrase of k - 1 words begins that has reached the threshold, its hash, step and first step.
    steps = steps[at]
    place = np.flatnonzero(steps != UNSET)
    h, steps, act = hashes[at[place]], steps[place], np.zeros(len(place), np.uint8)
    for k in range(2, longest + 1):
        left = np.flatnonzero(place[1:] == place[:-1] + 1)
        right = left + 1
        # As in levels: no phrase begins before its subphrases.
        act = np.maximum(1 + np.maximum(steps[left], steps[right]), np.maximum(act[left], act[right]))
        counting = (act <= step) & (act > step - shards)
        if k == longest:
            left, right = left[counting], right[counting]
            slots = _slots(_mixed(h[left], h[right], k), k, len(reached), longest)
            yield slots[reached[slots] == UNSET]
            return
        h = _mixed(h[left], h[right], k)
        slots = _slots(h, k, len(reached), longest)
        steps = reached[slots]
        yield slots[counting & (steps == UNSET)]
        kept = np.flatnonzero(steps != UNSET)
        place, h, steps, act = place[left[kept]], h[kept], steps[kept], act[kept]


def _tallied(slots: list[np.ndarray], counts: list[np.ndarray] | None, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots in order and their counts, of ``least`` at most; without ``counts`` a slot counts 1 each time."""
    if counts is None:
        every = np.sort(np.concatenate(slots))
    else:
        every = np.sort(np.concatenate([s.astype(np.uint64) << np.uint64(16) | c for s, c in zip(slots, counts)]))
        slot, own = (every >> np.uint64(16)).astype(np.uint32), every & np.uint64(0xFFFF)
    here = every if counts is None else slot
    first = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])) if len(here) else np.zeros(0, np.int64)
    total = np.diff(first, append=len(here)) if counts is None else np.add.reduceat(own, first) if len(first) else own
    return here[first], np.minimum(total, least).astype(np.uint16)


def _sent(rows: Iterator[tuple], fields: str) -> Iterator[pa.RecordBatch]:
    """Rows of a number and binaries as batches of about ``SENT`` bytes."""
    names, held, size = [c.split()[0] for c in fields.split(", ")], [], 0

    def batch() -> pa.RecordBatch:
        block, *rest = zip(*held)
        return pa.record_batch([pa.array(block, pa.int32()), *[pa.array(x, pa.binary()) for x in rest]], names=names)

    for row in rows:
        held.append(row)
        size += 64 + sum(map(len, row[1:]))
        if size >= SENT:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _blocks(slots: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple[int, bytes]]:
    """Counts of distinct slots in order, block by block."""
    offsets, counts = (slots % SPAN).astype(np.int32), counts.astype(_kind(least))
    block = slots // SPAN
    starts = np.concatenate([[True], block[1:] != block[:-1]])[:len(block)]
    gaps, ends = _gaps(offsets, starts)
    first = np.flatnonzero(starts)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(block)]):
        yield int(block[a]), _pairs(offsets[a:b], gaps[ends[a - 1] if a else 0:ends[b - 1]], counts[a:b])


def _sketch(name: str, step: int, known, slots: int, shards: int, longest: int, least: int):
    """Counts by slot of the active, incomplete phrases of one shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = _known(name, slots, known)
        held, size, done = [], 0, []
        for b in batches:
            for hashes, words in zip(b.column("hashes"), b.column("words")):
                for found in under_way(*_numbers(hashes.as_py(), words.as_py()), reached, step, shards, longest):
                    held.append(found.astype(np.uint32))
                    size += len(found)
                if size >= SORTED:
                    done.append(_tallied(held, None, least))
                    held, size = [], 0
        if held:
            done.append(_tallied(held, None, least))
            del held
        if done:
            total = done[0] if len(done) == 1 else _tallied(*map(list, zip(*done)), least)
            del done
            yield from _sent(_blocks(*total, least), _SKETCH)
    return run


def _texts(name: str, known, slots: int, longest: int):
    """Counts by text of the phrases whose slots have reached the threshold and, as k = 0, of all words."""
    def rows(lang: str, k: int, phrases: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        return pa.record_batch([
            pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))), pa.array(np.full(n, k, np.int32)),
            pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64))],
            names=[c.split()[0] for c in _COUNTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = _known(name, slots, known)
        for b in batches:
            for lang, distinct, hashes, words in zip(*(b.column(c) for c in ("lang", "vocabulary", "hashes", "words"))):
                lang, distinct = lang.as_py(), distinct.as_py().split(b" ")
                at, hashes = _numbers(hashes.as_py(), words.as_py())
                at = at.astype(np.int64)
                for x in levels(at, hashes, reached, longest):
                    often = np.flatnonzero(x.reached != UNSET)
                    if x.k == 1:
                        yield rows(lang, 0, [b""], x.counts[1:].sum(keepdims=True))
                        yield rows(lang, 1, [distinct[i] for i in often.tolist()], x.counts[often])
                    else:
                        parts = [map(distinct.__getitem__, at[x.first[often] + i].tolist()) for i in range(x.k)]
                        yield rows(lang, x.k, list(map(b" ".join, zip(*parts))), x.counts[often])
    return run


def _kind(least: int) -> type:
    """What holds counts of up to ``least``."""
    return np.uint8 if least < 1 << 8 else np.uint16


def _gaps(offsets: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places in order as bytes, each the distance to the one before (255 as often as that holds it, then
    the rest), and where the bytes of each end; a block ``starts`` at its own first place."""
    gap = np.diff(offsets.astype(np.int32), prepend=np.int32(0))
    if starts is not None:
        gap = np.where(starts, offsets, gap)
    often, rest = gap // 255, gap % 255
    ends = np.cumsum(often + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = rest
    return out, ends


def _pairs(offsets: np.ndarray, gaps: np.ndarray, counts: np.ndarray) -> bytes:
    """A block's counts, the shorter of two forms: all of them, or (after a byte of 0) those above 0 with the
    ``gaps`` between their places.  Long ones are packed, after a byte of 1 or 2."""
    if 5 + len(gaps) + counts.nbytes < SPAN * counts.itemsize:
        raw, kind = len(offsets).to_bytes(4, "little") + counts.tobytes() + gaps.tobytes(), b"\1"
    else:
        every = np.zeros(SPAN, counts.dtype)
        every[offsets] = counts
        raw, kind = every.tobytes(), b"\2"
    if len(raw) >= PACKED:
        packed = kind + zlib.compress(raw, 1)
        if len(packed) < len(raw):
            return packed
    return raw if kind == b"\2" else b"\0" + raw


def _packed(used: np.ndarray, counts: np.ndarray, least: int) -> bytes:
    """As :func:`_pairs`, of all counts of a block and the places ``used``."""
    return _pairs(used, _gaps(used)[0], counts[used].astype(_kind(least)))


def _add_to(total: np.ndarray, raw: bytes, least: int) -> None:
    """Sums are of ``least`` at most, which keeps them within 16 bits."""
    kind = np.dtype(_kind(least))
    every = len(total) * kind.itemsize
    form = 2 if len(raw) == every else raw[0]
    if form:
        raw = raw if len(raw) == every else zlib.decompress(memoryview(raw)[1:])
    if form == 2:
        total += np.frombuffer(raw, kind)
        np.minimum(total, least, out=total)
        return
    start = 5 - form
    n = int.from_bytes(raw[start - 4:start], "little")
    gaps = np.frombuffer(raw, np.uint8, offset=start + n * kind.itemsize)
    at = np.cumsum(gaps, dtype=np.int32)[gaps != 255]
    total[at] = np.minimum(total[at] + np.frombuffer(raw, kind, n, start), least)


def _full(total: np.ndarray, least: int) -> bytes:
    """The places that have reached ``least``, or a bit for each place where that is shorter."""
    full = total >= least
    places = np.flatnonzero(full).astype(np.uint32).tobytes()
    return places if len(places) < SPAN // 8 else np.packbits(full).tobytes()


def _places(full: bytes) -> np.ndarray:
    if len(full) < SPAN // 8:
        return np.frombuffer(full, np.uint32).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(full, np.uint8)))


def _added(least: int):
    """Blocks of one number, which come one after the other, added up: the counts below ``least``, and
    the places that have reached it."""
    def row(block: int, total: np.ndarray) -> tuple[int, bytes, bytes]:
        full = _full(total, least)
        total[total >= least] = 0
        return block, _packed(np.flatnonzero(total), total, least), full

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, bytes]]:
        at, total = None, None
        for b in batches:
            for block, raw in zip(b.column("block").to_pylist(), b.column("counts")):
                if block != at:
                    if at is not None:
                        yield row(at, total)
                    at, total = block, np.zeros(SPAN, np.uint16)
                _add_to(total, raw.as_py(), least)
        if at is not None:
            yield row(at, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sent(rows(batches), _ADDED)
    return run


def slots_for(size: int) -> int:
    """Slots for so many bytes of text."""
    return min(MOST, max(FEWEST, 1 << (size // SLOT_BYTES).bit_length()))


def _scan(cut: DataFrame, size: int, of_task: int = TASK_BYTES) -> DataFrame:
    """A scan of shards with so many bytes of text, in few tasks."""
    return cut.coalesce(max(cut.sparkSession.sparkContext.defaultParallelism, size // of_task))


def _removed(table: DataFrame | None) -> None:
    """Remove a written table that nothing reads any more."""
    files = table.inputFiles() if table is not None else []
    if files:
        delete_folder(table.sparkSession, files[0].rpartition("/")[0])


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS,
                  slots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, n) of all phrases of up to ``longest`` words that occur ``least`` times,
    (lang, n) with all word occurrences)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    path = scratch_path(spark, "phrase-shards")
    docs.mapInArrow(_cut(shards), _BLOCKS).write.partitionBy("shard").parquet(path)
    cut = spark.read.schema(_BLOCKS).parquet(path)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = slots or slots_for(size)
    reached = Known(slots)

    so_far, step, last_new = None, 0, -1
    while step < shards or step <= last_new + shards:
        if step == UNSET:
            raise RuntimeError(f"no end after {UNSET} steps")
        known = spark.sparkContext.broadcast(reached.packed())
        shard = cut.where(F.col("shard") == step % shards).select("hashes", "words")
        counted = _scan(shard, size // shards).mapInArrow(_sketch(f"{path} {step}", step, known, slots, shards, longest, least), _SKETCH)
        both = counted if so_far is None else so_far.select("block", "counts").unionByName(counted)
        dealt = both.repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block")
        old, so_far = so_far, materialise(dealt.mapInArrow(_added(least), _ADDED), "phrase-slots")
        known.destroy()  # the step's counts are written
        _removed(old)
        full = [r.block * SPAN + _places(bytes(r.full)) for r in so_far.select("block", "full").where(F.octet_length("full") > 0).collect()]
        if full and reached.add(np.concatenate(full), step):
            last_new = step
        step += 1
    _removed(so_far)
    known = spark.sparkContext.broadcast(reached.packed())
    every = materialise(_scan(cut, size, LAST_BYTES).mapInArrow(_texts(f"{path} {step}", known, slots, longest), _COUNTS).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
                        .where((F.col("n") >= least) | (F.col("k") == 0)), "phrases")
    known.destroy()
    delete_folder(spark, path)
    return every.where("k > 0"), every.where("k = 0").select("lang", "n")


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def _parts(often: DataFrame, part: str, n: str) -> DataFrame:
    """Counts by phrase, single words copied to every salt."""
    copies = F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return often.select("lang", F.col("phrase").alias(part), F.col("n").alias(n), F.explode(copies).alias("salt"))


def scored(often: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, score): every phrase of two words or more with its lowest cut."""
    words = F.split("phrase", " ")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = (often.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"),
                                        F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .withColumn("head", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " "))
            .withColumn("tail", F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ")))
    both = (cuts.withColumn("salt", F.when(F.col("cut") == 1, salt).otherwise(0))
            .join(_parts(often, "head", "l"), ["lang", "head", "salt"])
            .withColumn("salt", F.when(F.col("k") - F.col("cut") == 1, salt).otherwise(0))
            .join(_parts(often, "tail", "r"), ["lang", "tail", "salt"]))
    whole = both.withColumn("up", _exact(F.col("a")) * F.lit(2000000).cast("decimal(7,0)")).withColumn(
        "score", F.expr("up div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    return (whole.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"),
                                                F.first("a").alias("a"), F.first("k").alias("k"))
            .select("lang", "phrase", "k", "a", "low.l", "low.r", "low.score"))


def covered(often: DataFrame) -> DataFrame:
    """(lang, phrase, most): the count of the most frequent longer phrase that holds a phrase."""
    words = F.split("phrase", " ")
    spans = F.expr("flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), "
                   "i -> array_join(slice(w, i, s), ' '))))")
    return (often.where("k > 2").withColumn("w", words).select("lang", "n", F.explode(spans).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("n").alias("most")))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS,
                 slots: int | None = None, best: int = BEST, share: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and 0x0A-0x0D and into words at
    space and tab.  Null texts count as empty, a null lang as ``und``; repeated rows and copies
    count as often as they occur; ties are ranked by count and phrase bytes, so ranks are
    unique.  Other columns are ignored; an empty table gives an empty table.
    """
    often, words = phrase_counts(docs, least, longest, shards, slots)
    kept = (scored(often).join(covered(often), ["lang", "phrase"], "left")
            .where(F.col("most").isNull() | (_exact(F.col("most")) * 100 < _exact(F.col("a")) * share)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    top = (kept.withColumn("salt", salt)
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
           .where(F.col("rank") <= best)
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
           .where(F.col("rank") <= best))
    return (top.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
