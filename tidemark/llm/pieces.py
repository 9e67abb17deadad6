"""SentencePiece (BPE) encoding with seeded merge-dropout, and lossless decoding.

A text is cut where no piece of the vocabulary can reach: before a run of spaces and at
line ends.  Each chunk starts as single characters (characters without a piece of their
own as bytes) and is merged by an agenda, best score first, the left one of equals.  A
candidate merge is skipped when a hash keyed by seed, text, the chunk's place in the text and
the candidate's place falls below the dropout rate; a skipped candidate never returns, though
later merges may make others of its parts.  With dropout 0 the result is the tokenizer's
own segmentation.

A candidate's fate depends on its identity alone, so popping it from the agenda and
skipping it is the same as never entering it.  That lets all chunks of one length be
merged in step in numpy: one best candidate for every chunk a round.  Each task remembers
(bounded) the undropped merge of a chunk and the candidates that it meets; it holds for every
occurrence that skips none of them.  All other occurrences, and chunks that a batch of rows holds
once, are merged on their own.  The tokenizer file is read on the executors by its path.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 17
#: Chunks that a task remembers, at most.
REMEMBERED = 250_000
#: Longer chunks are merged one by one with a heap.
IN_STEP = 40
#: Occurrences whose dropout is looked at together, at most.
TOGETHER = 1 << 17
_SPACE, _CHUNK = "▁", re.compile(r" *[^ \n]+| +|\n")
_NONE = 1 << 30
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Vocabulary:
    """Pieces, scores and the table of merges of a SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = {p: i for i, p in enumerate(pieces)
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))}
        if any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in plain):
            raise ValueError("a piece reaches over a space or a line end; texts can't be cut there")
        self.size = n
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.surface = [p.replace(_SPACE, " ").encode() for p in pieces]
        for b, i in enumerate(self.byte):
            self.surface[i] = bytes([b])
        self.first = np.arange(0x110000, dtype=np.int32) + np.int32(n)  # unknown characters: n + code point
        for p, i in plain.items():
            if len(p) == 1:
                self.first[ord(p)] = i
        # A space stands for itself; the mark as text goes through bytes, to decode as it was.
        self.first[ord(" ")], self.first[ord(_SPACE)] = self.first[ord(_SPACE)], n + ord(_SPACE)
        keys, ids = [], []
        for p, i in plain.items():
            for cut in range(1, len(p)):
                a, b = plain.get(p[:cut]), plain.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * (1 << 22) + b)
                    ids.append(i)
        self.score = np.array([sp.get_score(i) for i in range(n)])
        order = np.argsort(-self.score, kind="stable")
        self.rank = np.full(n + 1, _NONE, np.int32)  # the last one is found under piece -1
        self.rank[order] = np.unique(-self.score[order], return_inverse=True)[1]
        self._hash(np.array(keys, np.int64), np.array(ids, np.int64))

    def _hash(self, keys: np.ndarray, ids: np.ndarray) -> None:
        bits = max(10, int(np.ceil(np.log2(len(keys) + 1))) + 2)
        self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ids = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        self.probes = 0
        while len(left):
            free = self.keys[at] < 0
            slot, pick = np.unique(at[free], return_index=True)
            own = left[free][pick]
            self.keys[slot], self.ids[slot] = keys[own], ids[own]
            stay = self.keys[at] != keys[left]
            left, at = left[stay], (at[stay] + 1) & mask
            self.probes += 1
        self.mask = mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _ODD) >> self.shift).astype(np.int64)

    def merge(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, rank) of the merge of two symbols; rank ``_NONE`` when there is none."""
        keys = (a.astype(np.int64) << 22) + b
        at = self._home(keys)
        got = self.keys[at]
        miss = np.flatnonzero(got != keys)
        ids = self.ids[at]
        ids[miss] = -1
        open_ = miss[got[miss] >= 0]
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            got = self.keys[at[open_]]
            hit = got == keys[open_]
            ids[open_[hit]] = self.ids[at[open_[hit]]]
            open_ = open_[(got >= 0) & ~hit]
        return ids, self.rank[ids]

    def bytes_of(self, symbol: int) -> list[int]:
        """Output ids of one symbol: itself, or the bytes of an unknown character."""
        if symbol < self.size:
            return [symbol]
        return [self.byte[b] for b in chr(symbol - self.size).encode("utf-8", "surrogatepass")]


def place_of(start, mid, end) -> np.ndarray:
    return (np.asarray(start, np.uint64) << np.uint64(42)) ^ (np.asarray(mid, np.uint64) << np.uint64(21)) \
        ^ np.asarray(end, np.uint64)


def dropped_at(keys: np.ndarray, place: np.ndarray, dropout: float) -> np.ndarray:
    h = _mix(_mix(np.atleast_1d(keys ^ (np.atleast_1d(place) * _ODD))) + _ODD)
    return (h >> np.uint64(11)).astype(float) < dropout * float(1 << 53)


def dropped(keys: np.ndarray, start, mid, end, dropout: float) -> np.ndarray:
    """Whether the candidate merge of [start, mid) and [mid, end) is skipped, by keyed hash."""
    return dropped_at(keys, place_of(start, mid, end), dropout)


def segment_in_step(vocab: Vocabulary, chars: np.ndarray, keys: np.ndarray, dropout: float,
                    seen: list | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Merge rows of equal length together: [(row numbers, their symbols)].

    ``seen`` gets the (row numbers, places) of the candidates that were met.
    """
    rows, n = np.arange(len(chars)), chars.shape[1]
    if n == 1:
        return [(rows, vocab.first[chars])]

    def candidates(a, b, row, s, m, e):
        """(piece, rank and place as one number) of merges of [s, m) and [m, e)."""
        ids, rank = vocab.merge(a, b)
        live = np.flatnonzero(rank < _NONE)
        best = np.full(len(ids), _NONE, np.int32)
        if seen is not None or dropout:
            own, place = row[live], place_of(s[live], m[live], e[live])
            if seen is not None:
                seen.append((own, place))
            if dropout:
                live = live[~dropped_at(keys[own], place, dropout)]
        best[live] = rank[live] << 6 | s[live]
        return ids, best

    # Place by row: a symbol stands where it starts, -1 where none starts any more.
    wide = len(rows)
    out = sym = np.ascontiguousarray(vocab.first[chars].T)
    after = np.repeat(np.arange(1, n + 1, dtype=np.int32), wide).reshape(n, wide)
    before = np.repeat(np.arange(-1, n, dtype=np.int32), wide).reshape(n + 1, wide)
    into, best = np.zeros((n, wide), np.int32), np.full((n, wide), _NONE, np.int32)
    s = after[:-1].ravel() - 1
    pairs = candidates(sym[:-1].ravel(), sym[1:].ravel(), np.tile(rows, n - 1), s, s + 1, s + 2)
    into[:-1], best[:-1] = (x.reshape(n - 1, wide) for x in pairs)
    while True:
        top = best.min(0)
        go = np.flatnonzero(top < _NONE)
        if len(go) < wide // 2 or not len(go):
            if sym is not out:
                out[:, rows] = sym
            if not len(go):
                break
            rows, top, sym, after, before, into, best = (np.take(x, go, -1) for x in (rows, top, sym, after, before, into, best))
            wide, go = len(rows), np.arange(len(rows))
        flat_sym, flat_after, flat_before, flat_into, flat_best = (x.reshape(-1) for x in (sym, after, before, into, best))
        j = top[go] & 63
        left = j * wide + go
        mid = flat_after[left] * wide + go
        end = flat_after[mid]
        flat_sym[left], flat_sym[mid] = flat_into[left], -1
        flat_best[left] = flat_best[mid] = _NONE
        flat_after[left] = end
        flat_before[end * wide + go] = j
        prev = flat_before[left]
        one, two = np.flatnonzero(prev >= 0), np.flatnonzero(end < n)
        col = np.concatenate([go[one], go[two]])
        s, m = np.concatenate([prev[one], j[two]]), np.concatenate([j[one], end[two]])
        at, right = s * wide + col, m * wide + col
        flat_into[at], flat_best[at] = candidates(flat_sym[at], flat_sym[right], rows[col], s, m, flat_after[right])
    stand = out >= 0
    width = stand.sum(0)
    done = []
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        part = out[:, own].T
        done.append((own, part[part >= 0].reshape(-1, w)))
    return done


def segment_one(vocab: Vocabulary, chunk: str, key: np.uint64, dropout: float) -> list[int]:
    """The symbols of one chunk, by an agenda on a heap; for long chunks."""
    sym = vocab.first[np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), np.uint32)].tolist()
    n = len(sym)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def enter(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and after[i] < n]
        if not lefts:
            return
        mids = [after[i] for i in lefts]
        ids, rank = vocab.merge(np.array([sym[i] for i in lefts]), np.array([sym[m] for m in mids]))
        ends = [end[m] for m in mids]
        live = rank < _NONE
        if dropout:
            live &= ~dropped(key, lefts, mids, ends, dropout)
        for at in np.flatnonzero(live):
            heapq.heappush(heap, (int(rank[at]), lefts[at], mids[at], ends[at], int(ids[at])))

    enter(list(range(n - 1)))
    alive = [True] * n
    while heap:
        _, i, m, e, piece = heapq.heappop(heap)
        if not (alive[i] and m < n and alive[m] and after[i] == m and end[m] == e):
            continue
        sym[i], alive[m], after[i], end[i] = piece, False, after[m], e
        if after[i] < n:
            before[after[i]] = i
        enter([before[i], i])
    return [sym[i] for i in range(n) if alive[i]]


class Encoder:
    """Encodes texts; remembers the undropped merge of chunks and the candidates it meets."""

    def __init__(self, path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED):
        self.vocab, self.dropout, self.seed = Vocabulary(path), dropout, seed
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: Places of the candidates that chunk i meets: places[first[i]:first[i] + met[i]].
        self.places, self.first, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _segment(self, chunks: list[str], keys: np.ndarray, dropout: float, seen: list | None = None
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lens) of chunks with their keys."""
        size = self.vocab.size
        chars = np.fromiter(map(len, chunks), np.int64, len(chunks))
        found: list[tuple[np.ndarray, np.ndarray]] = []  # chunk numbers, their ids (one length)
        odd: list[tuple[int, list[int]]] = []            # chunk number, symbols with unknown characters
        for n in np.unique(chars[chars <= IN_STEP]):
            rows = np.flatnonzero(chars == n)
            joined = "".join([chunks[i] for i in rows.tolist()])
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(rows), n)
            met: list | None = None if seen is None else []
            for own, sym in segment_in_step(self.vocab, points, keys[rows], dropout, met):
                plain = (sym < size).all(1)
                found.append((rows[own[plain]], sym[plain]))
                odd += zip(rows[own[~plain]].tolist(), sym[~plain].tolist())
            if seen is not None:
                seen += [(rows[own], place) for own, place in met]
        odd += [(r, segment_one(self.vocab, chunks[r], keys[r], dropout))
                for r in np.flatnonzero(chars > IN_STEP).tolist()]
        for r, sym in odd:
            ids = [x for y in sym for x in self.vocab.bytes_of(y)]
            found.append((np.array([r]), np.array([ids])))
        lens = np.zeros(len(chunks), np.int64)
        for rows, ids in found:
            lens[rows] = ids.shape[1]
        starts = np.cumsum(lens) - lens
        flat = np.empty(int(lens.sum()), np.int32)
        for rows, ids in found:
            flat[starts[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, starts, lens

    def _learn(self, chunks: list[str]) -> None:
        """Merge chunks that are not known yet without dropout."""
        seen: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        flat, starts, lens = self._segment(chunks, np.zeros(len(chunks), np.uint64), 0, seen)
        rows, places = (np.concatenate(x) for x in zip(*seen))
        met = np.bincount(rows, minlength=len(chunks))
        self.known.update(zip(chunks, range(len(self.lens), len(self.lens) + len(chunks))))
        self.first = np.r_[self.first, np.cumsum(met) - met + len(self.places)]
        self.places, self.met = np.r_[self.places, places[np.argsort(rows, kind="stable")]], np.r_[self.met, met]
        self.starts = np.concatenate([self.starts, starts + len(self.flat)])
        self.flat, self.lens = np.concatenate([self.flat, flat]), np.concatenate([self.lens, lens])

    def _differs(self, at: np.ndarray, keys: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Whether occurrences of known chunks skip a candidate of the undropped merge (or are long)."""
        out = chars > IN_STEP
        for i in range(0, len(at), TOGETHER):
            own = at[i:i + TOGETHER]
            met = self.met[own]
            pick = np.repeat(self.first[own] - (np.cumsum(met) - met), met) + np.arange(int(met.sum()))
            owner = np.repeat(np.arange(i, i + len(own)), met)
            out[owner[dropped_at(keys[owner], self.places[pick], self.dropout)]] = True
        return out

    def _recall(self, chunks: list[str]) -> np.ndarray:
        """Numbers of the chunks that are remembered, after learning those met twice here (-1: met once)."""
        at = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        strange = np.flatnonzero(at < 0).tolist()
        least = 2 if self.dropout else 1
        new = [c for c, n in Counter([chunks[i] for i in strange]).items() if n >= least]
        if len(self.lens) + len(new) > REMEMBERED:
            self._forget()
            strange = range(len(chunks))
            new = [c for c, n in Counter(chunks).items() if n >= least]
        if new:
            self._learn(new)
            at[strange] = [self.known.get(chunks[i], -1) for i in strange]
        return at

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]."""
        # One space goes before a text, as the tokenizer adds it; decoding takes it off.
        cut = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        words = np.cumsum([0, *map(len, cut)])
        chunks = [c for own in cut for c in own]
        at = self._recall(chunks)
        flat, starts, n = self.flat, np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        known = np.flatnonzero(at >= 0)
        starts[known], n[known] = self.starts[at[known]], self.lens[at[known]]
        if self.dropout and chunks:
            own = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), self.seed) if t else 0
                            for t in texts], np.uint64)
            nth = np.arange(len(chunks)) - np.repeat(words[:-1], np.diff(words))
            keys = _mix(np.repeat(own, np.diff(words)) + nth.astype(np.uint64) * _ODD)
            alone = at < 0
            chars = np.fromiter(map(len, chunks), np.int64, len(chunks))
            alone[known] = self._differs(at[known], keys[known], chars[known])
            other = np.flatnonzero(alone)
            for i in range(0, len(other), TOGETHER):
                part = other[i:i + TOGETHER]
                ids, begin, size = self._segment([chunks[j] for j in part.tolist()], keys[part], self.dropout)
                starts[part], n[part] = begin + len(flat), size
                flat = np.concatenate([flat, ids])
        ends = np.cumsum(n)
        ids = flat[np.repeat(starts - (ends - n), n) + np.arange(int(n.sum()))]
        return np.r_[0, ends][words].astype(np.int32), ids


@lru_cache(maxsize=2)
def encoder_for(path: str, dropout: float, seed: int) -> Encoder:
    """The worker's own encoder: later tasks go on with what it remembers."""
    return Encoder(path, dropout, seed)


@lru_cache(maxsize=2)
def surface_of(path: str) -> list[bytes]:
    return Vocabulary(path).surface


def decode_ids(surface: list[bytes], ids: list[int]) -> str:
    """The text of piece ids; the space that encoding put first is taken off."""
    raw = b"".join([surface[i] for i in ids])
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def encode(docs: DataFrame, path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED,
           column: str = "ids") -> DataFrame:
    """``docs`` with an array column of piece ids of its text.

    Null and empty texts have no ids.  Equal texts have equal ids under one seed; other
    columns pass through, and ``column`` must not be one of them.  An empty table stays empty.
    """
    if column in docs.columns:
        raise ValueError(f"docs has a column {column!r} already")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path, dropout, seed)
        for b in _slices(batches):
            offsets, ids = encoder.encode(b.column(at).to_pylist())
            out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str = MODEL, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its piece ids; null ids give a null text, no ids an empty one."""
    if into in encoded.columns:
        raise ValueError(f"encoded has a column {into!r} already")
    at = encoded.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surface = surface_of(path)
        for b in _slices(batches):
            texts = [None if x is None else decode_ids(surface, x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, into])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(into, T.StringType())]))


def recode(docs: DataFrame, path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED,
           column: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of its text, and ``text`` replaced by what they decode to.

    :func:`encode` and :func:`decode` in one pass, so a task needs one Python worker.  Null
    and empty texts have no ids and come out empty.
    """
    if column in docs.columns:
        raise ValueError(f"docs has a column {column!r} already")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path, dropout, seed)
        for b in _slices(batches):
            offsets, ids = encoder.encode(b.column(at).to_pylist())
            listed = ids.tolist()
            texts = pa.array([decode_ids(encoder.vocab.surface, listed[i:j]) for i, j in zip(offsets, offsets[1:])], pa.string())
            columns = [texts if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                                             names=[*b.schema.names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, ids, n_ids, decoded_sha256, lossless) for every row of ``docs``.

    lossless: the text decoded from the ids has the digest of the text itself (null: empty).
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("sha256", F.sha2("text", 256))
    decoded = F.sha2("text", 256)
    return recode(own, **options).select("doc_id", "ids", F.size("ids").alias("n_ids"), decoded.alias("decoded_sha256"),
                                         (F.col("sha256") == decoded).alias("lossless"))
