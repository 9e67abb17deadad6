"""Language-model scores: a causal self-attention model over subword ids.

Counting (whole corpus).  One pass counts the words of all training documents; the counts
are merged in a shuffle.  Words with at least 2 ** -20 of all tokens (at most 2 ** 20 of
them, whatever the corpus) are broadcast as hashes; the rest meets its counts in a join in
which no key can be frequent.  How new words are spelled follows from the distinct words:
which byte-level BPE ids begin one, follow an id or a whole beginning, and end one (again
only shares of 2 ** -20 and more are kept, the rest backs off).

Model.  A word is recalled with its discounted share of the training tokens, or spelled id
by id with the weight that the discounts left over: a proper distribution over all words.
A causal self-attention layer over the ids before, trained in numpy, re-weights the words
by classes of the id that they begin with: p(w) = base(w) exp(s[class w]) / sum over
classes of base(class) exp(s).  The sum is over classes, so it is exact for all words.  Ids
enter the layer as vectors from their co-occurrence with frequent ids (a Spark job).

A second head copies: with weight ``COPY`` (0.1) it looks at all words of the document
before, evenly, and gives its weight to the words found there.

Training.  The training documents' ids are stored once, 2 bytes each; every pass cuts its windows
from them.  All windows of all training documents are learned from, each in the round that
its hash picks.  Each task makes its own steps from the shared weights; their mean, weighted
by windows, is the next round's start.

Scoring.  Windows of 64 ids overlap by 16 that are context only, so every id is scored
once; a batch of windows goes through the masked attention together.  Documents are never
shuffled; only rare words and sums by document are.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, words_of  # noqa: F401

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Ids: the vocabulary's and one more for a text's end (which also stands before its start).
VOCAB, END = 50_257, 50_256
#: Words with 2 ** -HEAVY of the tokens, and spelling steps with 2 ** -KEEP of the steps, are
#: broadcast: at most 2 ** HEAVY and 2 ** KEEP entries.
HEAVY, KEEP = 20, 20
SCORED, CONTEXT = 48, 16
WINDOW = SCORED + CONTEXT
DIMS, CLASSES, LANDMARKS = 16, 48, 64
ROUNDS, BATCH, RATE = 4, 16, 0.02
#: Off each distinct word's count, off each kept step's count, and onto each id's count.
RECALL_DISCOUNT, DISCOUNT, SMOOTH = 0.75, 0.8, 0.02
#: Weight of copying a word that the document had before.
COPY = 0.1
REMEMBERED = 400_000


def is_held_out(doc_id: int | None, modulus: int, remainder: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == remainder


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2048, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of up to ``rows`` rows and about ``size`` bytes (a longer row is a slice by itself)."""
    for b in batches:
        at = 0
        while at < b.num_rows:
            n = min(rows, b.num_rows - at)
            while n > 1 and b.slice(at, n).nbytes > size:
                n //= 2
            yield b.slice(at, n)
            at += n


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, ends, distinct) of a batch: text i has the words distinct[codes[ends[i - 1]:ends[i]]].

    The same words as :func:`words_of` gives, without an object for each.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    ends = np.r_[0, np.cumsum(full)][lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]
    coded = words.filter(pa.array(full)).dictionary_encode()
    return coded.indices.to_numpy(), ends, coded.dictionary.cast(pa.binary())


def listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()  # many times faster than to_pylist


class Subwords:
    """Words (UTF-8 bytes) to byte-level BPE ids; remembers a bounded number of words.

    With a base distribution it also remembers each word's probability of being spelled, and
    its recalled share and base score (NaN and 0 for words that are not broadcast).
    """

    def __init__(self, path: str = RANKS, base: Base | None = None):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(VOCAB, bool)
        self.spaced[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self.base = base
        self.forget()

    def forget(self) -> None:
        self.place: defaultdict[bytes, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.known = self.filled = 0
        self.ids = np.zeros(0, np.int32)
        self.starts, self.lens = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.spelled, self.recall, self.unigram = np.zeros(0), np.zeros(0), np.zeros(0)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lens): the ids of each word behind a space, one word after the other.

        No id reaches over a space, so words without Unicode spaces are encoded as one text, in
        which each id that begins with a space begins a word.
        """
        text = (b" " + b" ".join(words)).decode("utf-8", "replace")
        if len(text.split()) == len(words):
            ids = self.encoding.encode_to_numpy(text).astype(np.int32)
            first = np.flatnonzero(self.spaced[ids])
            if len(first) == len(words):
                return ids, np.diff(np.r_[first, len(ids)])
        coded = [self.encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
        lens = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.fromiter((i for c in coded for i in c), np.int32, int(lens.sum())), lens

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """The places of distinct words among the remembered ones; new ones are learned."""
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        if len(self.place) > max(REMEMBERED, self.known):
            self.forget()
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        if len(self.place) > self.known:
            self._learn([words[i] for i in np.flatnonzero(at >= self.known)])
        return at

    def _learn(self, new: list[bytes]) -> None:
        ids, lens = self.encode(new)
        starts, known, filled = np.cumsum(lens) - lens, self.known, self.filled
        self.known, self.filled = known + len(new), filled + len(ids)
        self.ids = put(self.ids, filled, ids)
        self.starts, self.lens = put(self.starts, known, starts + filled), put(self.lens, known, lens)
        if self.base:
            shares = self.base.words
            n = shares.count(new)
            self.spelled = put(self.spelled, known, shares.spelled * np.exp(self.base.spell(ids.astype(np.int64), starts, lens)))
            self.recall = put(self.recall, known, np.where(n > 0, (n - RECALL_DISCOUNT) / max(shares.tokens, 1), np.nan))
            self.unigram = put(self.unigram, known, np.where(n > 0, np.log10((n + 1) / shares.space), 0))

    def places(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """For each text, its words' places among the remembered words."""
        self.look_up(list(set().union(*texts)) if texts else [])
        get = self.place.__getitem__
        return [np.fromiter(map(get, ws), np.int64, len(ws)) for ws in texts]

    def text(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, steps): a text's ids with END first and last, and the steps (the number of ids
        before, without the first END) at which a word or the end begins."""
        n = self.lens[at]
        return np.r_[END, self.ids[ragged(self.starts[at], n)], END], np.r_[0, np.cumsum(n)]

    def texts(self, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, begins) of texts, one after the other; text i has the words at[ends[i - 1]:ends[i]].

        ids: each text's ids with END first and last.  sizes: its steps, one fewer than its ids.
        begins: whether a word or the end begins at a step.
        """
        n = self.lens[at]
        upto = np.r_[0, np.cumsum(n)]
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        last = upto[ends] + np.arange(len(ends))  # the step of each text's end
        sizes = np.diff(last, prepend=-1)
        begins = np.zeros(upto[-1] + len(ends), bool)
        begins[upto[:-1] + owner] = True
        begins[last] = True
        ids = np.full(upto[-1] + 2 * len(ends), END, np.int32)
        inside = np.ones(len(ids), bool)
        close = np.cumsum(sizes + 1) - 1
        inside[close] = inside[close - sizes] = False
        ids[inside] = self.ids[ragged(self.starts[at], n)]
        return ids, sizes, begins


def put(kept: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``kept`` with ``more`` at ``at``; grows by doubling, so what is kept is seldom copied."""
    if at + len(more) > len(kept):
        kept = np.r_[kept[:at], np.zeros(max(at, len(more)), kept.dtype)]
    kept[at:at + len(more)] = more
    return kept


def beginnings(ids: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """For each id of the words, a 64-bit hash of its word up to and with it."""
    out = np.zeros(len(ids), np.uint64)
    for d in range(int(lens.max()) if len(lens) else 0):
        at = starts[lens > d] + d
        before = out[at - 1] if d else np.zeros(len(at), np.uint64)
        out[at] = mix(before * np.uint64(0x9E3779B97F4A7C15) + ids[at].astype(np.uint64) + np.uint64(1))
    return out


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    order, out = np.argsort(wanted), np.empty(len(wanted))  # sorted, neighbours are found in the same cache lines
    wanted = wanted[order]
    at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
    out[order] = np.where(keys[at] == wanted, values[at], default)
    return out


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + lens[i] - 1, one run after the other."""
    return np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))


# --- counting -------------------------------------------------------------------------

def word_counts(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """(word, n) over the training documents; the null word counts the texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2048, 64 << 20):
            used = b.filter(pa.array([not is_held_out(d, modulus, remainder) for d in b.column(0).to_pylist()], pa.bool_()))
            codes, _, distinct = split_words(used.column(1))
            yield pa.record_batch([pa.concat_arrays([distinct, pa.nulls(1, pa.binary())]),
                                   pa.array(np.r_[np.bincount(codes, minlength=len(distinct)), used.num_rows].astype(np.int64))],
                                  names=["word", "n"])

    counts = docs.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where("n > 0")


class WordShares:
    """Counts of the broadcast words, by two 64-bit hashes of the word."""

    def __init__(self, counts: DataFrame):
        tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
        texts = counts.where("word IS NULL").head()
        self.tokens, self.distinct, self.texts = tokens, distinct, texts.n if texts else 0
        heavy = counts.where(F.col("word").isNotNull() & (F.col("n") * (1 << HEAVY) >= tokens)).toArrow()
        first = hashes(heavy.column("word").to_pylist(), 1)  # at most 2 ** HEAVY rows
        order = np.argsort(first)
        self.first, self.second = first[order], hashes(heavy.column("word").to_pylist(), 2)[order]
        self.n = heavy.column("n").to_numpy()[order]
        #: What the discounts leave for spelling.
        self.spelled = RECALL_DISCOUNT * (distinct - (self.texts > 0)) / tokens if distinct > 1 else 1.0

    def few(self, counts: DataFrame) -> DataFrame:
        """The words that are not broadcast."""
        return counts.where(F.col("word").isNotNull() & (F.col("n") * (1 << HEAVY) < self.tokens))

    def count(self, words: list[bytes]) -> np.ndarray:
        """Training count of each broadcast word; 0 for others."""
        if not len(self.first):
            return np.zeros(len(words), np.int64)
        wanted = hashes(words, 1)
        at = np.searchsorted(self.first, wanted).clip(max=len(self.first) - 1)
        hit = np.flatnonzero(self.first[at] == wanted)
        hit = hit[self.second[at[hit]] == hashes([words[i] for i in hit], 2)] if len(hit) else hit
        out = np.zeros(len(words), np.int64)
        out[hit] = self.n[at[hit]]
        return out

    @property
    def space(self) -> int:
        """The base score's denominator."""
        return self.tokens + self.distinct + 1


def hashes(words: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def step_counts(words: DataFrame, path: str) -> DataFrame:
    """(h, a, b, n, tokens) over the distinct words: b follows the word beginning h, which
    ends in a; b = -1: the word ends there; h = 0 and a = -1: b begins a word.  n counts
    words, tokens their occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = Subwords(path)
        for b in slices(batches, 50_000, 64 << 20):
            sub.forget()
            at = sub.look_up(listed(b.column(0)))
            n = np.repeat(b.column(1).to_numpy(), sub.lens[at])
            pick = ragged(sub.starts[at], sub.lens[at])
            ids, lens = sub.ids[pick], sub.lens[at]
            starts = np.cumsum(lens) - lens
            h = beginnings(ids, starts, lens).view(np.int64)
            after = np.r_[ids[1:], -1]
            after[np.cumsum(lens) - 1] = -1
            first = np.zeros(len(starts), np.int64)
            yield pa.record_batch([pa.array(np.r_[h, first]), pa.array(np.r_[ids, first - 1].astype(np.int32)),
                                   pa.array(np.r_[after, ids[starts]].astype(np.int32)), pa.array(np.r_[n, n[starts]])],
                                  names=["h", "a", "b", "tokens"])

    return (words.where("word IS NOT NULL").mapInArrow(count, "h long, a int, b int, tokens long")
            .groupBy("h", "a", "b").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")))


class Base:
    """The distribution of the next word, from the corpus counts; see the module's head.

    Spelling: after a word's beginning h that ends in a, what followed h (discounted) plus
    the rest of its weight times the bigram part, in which a word ends by ``end[a]`` and
    goes on by what followed a (discounted) plus the rest times the ids' shares.
    """

    def __init__(self, counts: DataFrame, words: WordShares):
        def column(df: DataFrame, key: str, value: str = "n") -> np.ndarray:
            got, out = df.groupBy(key).agg(F.sum(value).alias("n")).toArrow(), np.zeros(VOCAB)  # at most VOCAB rows
            out[got.column(key).to_numpy()] = got.column("n").to_numpy()
            return out

        self.words = words
        begin = counts.where("a = -1")
        start, begun = column(begin, "b"), column(begin, "b", "tokens")
        ends = column(counts.where("b = -1"), "a")
        inside = counts.where("a >= 0 AND b >= 0")
        after, follow = column(inside, "a"), column(inside, "b")
        total = float(max(1.0, after.sum() + ends.sum()))
        self.log_start = np.log((start + SMOOTH) / (start.sum() + SMOOTH * VOCAB))
        # Mass of all words that begin with an id, and of the end.
        self.begin = np.maximum(begun - RECALL_DISCOUNT * start, 0) / max(words.tokens, 1) + words.spelled * np.exp(self.log_start)
        self.log_end = float(np.log((words.texts + 0.5) / (words.tokens + 1)))
        rate = (ends.sum() + 0.5) / (ends.sum() + after.sum() + 1)
        self.end = (ends + rate) / (ends + after + 1)
        self.follow = (follow + SMOOTH) / (follow.sum() + SMOOTH * VOCAB)
        self.frequency = begun + column(inside, "b", "tokens")
        self.frequency[END] = words.texts
        often = F.col("n") * (1 << KEEP) >= total  # at most 2 ** KEEP rows pass, of pairs as of beginnings
        kept = inside.groupBy("a", "b").agg(F.sum("n").alias("n")).where(often).orderBy("a", "b").toArrow()
        self.a, self.b, n = (kept.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
        self.share = (n - DISCOUNT) / np.maximum(after[self.a], 1)
        self.pairs = self.a * VOCAB + self.b
        self.rest = 1 - np.bincount(self.a, self.share, VOCAB)
        spelled = counts.where("a >= 0")
        whole = spelled.groupBy("h").agg(F.sum("n").alias("whole")).where(F.col("whole") * (1 << KEEP) >= total)
        deep = spelled.where(often).join(whole, "h").select("h", "b", "n", "whole").toArrow()
        h, b, n, t = (deep.column(c).to_numpy() for c in ("h", "b", "n", "whole"))
        h, share = h.view(np.uint64), (n - DISCOUNT) / np.maximum(t, 1)
        key = self._deep(h, b.astype(np.int64))
        order = np.argsort(key)
        self.deep_keys, self.deep_share = key[order], share[order]
        self.nodes, at = np.unique(h, return_inverse=True)
        self.deep_rest = 1 - np.bincount(at, share, len(self.nodes))

    @staticmethod
    def _deep(h: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(h + (b + 2).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def spell(self, ids: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Log probability of spelling each word: its ids and its end."""
        h = beginnings(ids, starts, lens)
        on = np.ones(len(ids), bool)
        on[starts] = False
        on = np.flatnonzero(on)
        a, b, before = ids[on - 1], ids[on], h[on - 1]
        pair = look_up(self.pairs, self.share, a * VOCAB + b, 0.0) + self.rest[a] * self.follow[b]
        p = np.ones(len(ids))
        p[on] = (look_up(self.deep_keys, self.deep_share, self._deep(before, b), 0.0)
                 + look_up(self.nodes, self.deep_rest, before, 1.0) * (1 - self.end[a]) * pair)
        last = starts + lens - 1
        end = (look_up(self.deep_keys, self.deep_share, self._deep(h[last], np.full(len(last), -1)), 0.0)
               + look_up(self.nodes, self.deep_rest, h[last], 1.0) * self.end[ids[last]])
        return self.log_start[ids[starts]] + np.add.reduceat(np.log(p), starts) + np.log(end)

    def class_mass(self, classes: np.ndarray) -> np.ndarray:
        """Probability of all words (and the end) that begin with an id of each class."""
        mass = np.bincount(classes, self.begin, CLASSES)
        mass[classes[END]] += np.exp(self.log_end)
        return mass.astype(np.float32)


# --- vectors and classes of ids ---------------------------------------------------------

def train_texts(docs: DataFrame, modulus: int, remainder: int, path: str) -> DataFrame:
    """(ids, sizes, begins, seeds): the training documents as ids, some texts a row, as binary
    arrays (2 bytes an id, 8 a size, a bit a step, 4 a seed); see :meth:`Subwords.texts`.
    seeds: what a text's windows are hashed with.  A row begins about 2 ** 16 ids after the one
    before: rows of 0.5 MB and more are placed apart in the JVM's heap and swell it."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = Subwords(path)
        for b in slices(batches):
            used = b.filter(pa.array([not is_held_out(d, modulus, remainder) for d in b.column(0).to_pylist()], pa.bool_()))
            if not used.num_rows:
                continue
            codes, ends, distinct = split_words(used.column(1))
            ids, sizes, begins = sub.texts(sub.look_up(listed(distinct))[codes], ends)
            heads, steps = np.r_[0, np.cumsum(sizes + 1)], np.r_[0, np.cumsum(sizes)]
            seeds = np.array([zlib.crc32(ids[f:f + min(WINDOW, n + 1)].astype(np.int64).tobytes()) for f, n in zip(heads, sizes)], np.uint32)
            ids, rows = ids.astype(np.uint16), []
            cuts = [0, *np.flatnonzero(np.diff(heads[:-1] >> 16)) + 1, len(sizes)]
            for i, j in zip(cuts, cuts[1:]):
                parts = ids[heads[i]:heads[j]], sizes[i:j], np.packbits(begins[steps[i]:steps[j]]), seeds[i:j]
                rows.append([x.tobytes() for x in parts])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*rows)], names=["ids", "sizes", "begins", "seeds"])

    return docs.mapInArrow(encode, "ids binary, sizes binary, begins binary, seeds binary")


def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, begins, first, low, lens, nth) of each row of :func:`train_texts`: the texts' ids and
    marks of their steps, and the windows.

    As in scoring, a window is SCORED steps behind CONTEXT steps that are context only, and the
    ids before and after them.  A window's ids are ids[low:low + lens + 1] and its steps
    follow all but the last of them; the steps from ``first`` on are its own (begins is by the id
    before the step).  nth: the round that learns from the window, by hash.
    """
    for b in batches:
        for row in zip(*(b.column(c) for c in range(4))):
            ids, sizes, begins, seeds = (np.frombuffer(x.as_buffer(), t) for x, t in zip(row, (np.uint16, np.int64, np.uint8, np.uint32)))
            marks = np.zeros(len(ids), bool)
            inside = np.ones(len(ids), bool)
            inside[np.cumsum(sizes + 1) - 1] = False
            marks[inside] = np.unpackbits(begins, count=int(sizes.sum()))
            before = np.cumsum(sizes + 1) - (sizes + 1)
            windows = -(-sizes // SCORED)
            owner = np.repeat(np.arange(len(sizes)), windows)
            k = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            low = np.maximum(SCORED * k - CONTEXT, 0)
            lens = np.minimum(SCORED * (k + 1), sizes[owner]) - low
            nth = mix(seeds[owner].astype(np.uint64) + (k.astype(np.uint64) << np.uint64(32))) % np.uint64(ROUNDS)
            yield ids, marks, before[owner] + SCORED * k, before[owner] + low, lens, nth.astype(np.int32)


def train_windows(docs: DataFrame, modulus: int, remainder: int, path: str) -> DataFrame:
    """(ids, begins, nth): the windows of :func:`train_texts` as rows, each step of a text in one
    of them.  begins: whether a word or the end begins at the step (1), or a word goes on or is
    context (0)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, marks, first, low, lens, nth in windows_of(batches):
            step = ragged(low, lens)
            own = np.where(step >= np.repeat(first, lens), marks[step], False)
            lists = [pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(x.astype(np.int64)))
                     for n, x in ((lens + 1, ids[ragged(low, lens + 1)]), (lens, own))]
            yield pa.RecordBatch.from_arrays([*lists, pa.array(nth)], names=["ids", "begins", "nth"])

    return train_texts(docs, modulus, remainder, path).mapInArrow(cut, "ids array<long>, begins array<long>, nth int")


def cooccurrence(texts: DataFrame, landmarks: np.ndarray) -> np.ndarray:
    """counts[id, k]: how often the id shares a window with landmark k."""
    place = np.full(VOCAB, -1, np.int64)
    place[landmarks] = np.arange(len(landmarks))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, nth = np.zeros((VOCAB, len(landmarks))), np.zeros(VOCAB, np.int64)
        for ids, _, _, low, lens, _ in windows_of(batches):
            for at in range(0, len(low), 256):
                n = lens[at:at + 256] + 1
                some, owner = ids[ragged(low[at:at + 256], n)], np.repeat(np.arange(len(n)), n)
                mark = place[some]
                hit = np.flatnonzero(mark >= 0)
                seen = np.bincount(owner[hit] * len(landmarks) + mark[hit], minlength=len(n) * len(landmarks))
                unique = np.sort(some, kind="stable")  # 2-byte ids: a radix sort
                unique = unique[np.flatnonzero(np.r_[True, unique[1:] != unique[:-1]])]
                nth[unique] = np.arange(len(unique))
                held = np.bincount(nth[some] * len(n) + owner, minlength=len(unique) * len(n))
                # Counts by id and window times counts by window and landmark.
                out[unique] += held.reshape(len(unique), -1).astype(np.float32) @ seen.reshape(len(n), -1).astype(np.float32)
        row, k = np.nonzero(out)
        yield pa.record_batch([pa.array(row.astype(np.int32)), pa.array(k.astype(np.int32)),
                               pa.array(out[row, k].astype(np.float64))], names=["id", "k", "v"])

    # At most VOCAB * LANDMARKS rows.
    got = (texts.mapInArrow(count, "id int, k int, v double")
           .groupBy("id", "k").agg(F.sum("v").alias("v")).toArrow())
    counts = np.zeros((VOCAB, len(landmarks)))
    counts[got.column("id").to_numpy(), got.column("k").to_numpy()] = got.column("v").to_numpy()
    return counts


def vectors_and_classes(counts: np.ndarray, frequency: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id vectors (leading directions of smoothed log association) and their classes
    (k-means, word-beginning ids apart from the others)."""
    row, col = counts.sum(1, keepdims=True), counts.sum(0, keepdims=True)
    expected = row * col / max(counts.sum(), 1)
    assoc = np.log((counts + 5 * col / max(col.sum(), 1) + 1e-9) / (expected + 5 * col / max(col.sum(), 1) + 1e-9))
    weight = np.sqrt(np.minimum(frequency, 1e4) + 1e-3)[:, None]
    u, s, vt = np.linalg.svd(((assoc - assoc.mean(0)) * weight).T @ ((assoc - assoc.mean(0)) * weight))
    dims = min(DIMS, assoc.shape[1])
    vectors = np.zeros((VOCAB, DIMS))
    vectors[:, :dims] = (assoc - assoc.mean(0)) @ u[:, :dims]
    vectors /= np.sqrt((vectors ** 2 * (frequency / max(frequency.sum(), 1))[:, None]).sum(0)) + 1e-6
    classes, rng = np.zeros(VOCAB, np.int64), np.random.default_rng(5)
    for part, (own, k0, k) in enumerate(((starts, 0, CLASSES // 2), (~starts, CLASSES // 2, CLASSES // 2))):
        used = np.flatnonzero(own & (frequency > 0))
        if len(used) <= k:
            classes[own] = k0
            continue
        w = np.log1p(frequency[used])
        scaled = vectors[:, :8]
        centre = scaled[rng.choice(used, k, replace=False, p=w / w.sum())]
        for _ in range(20):
            near = ((scaled[used][:, None] - centre) ** 2).sum(2).argmin(1)
            for c in range(k):
                if (near == c).any():
                    centre[c] = np.average(scaled[used[near == c]], axis=0, weights=w[near == c])
        every = np.flatnonzero(own)
        for at in range(0, len(every), 4096):
            some = every[at:at + 4096]
            classes[some] = k0 + ((scaled[some][:, None] - centre) ** 2).sum(2).argmin(1)
    return np.clip(vectors, -4, 4).astype(np.float32), classes


# --- the attention layer ----------------------------------------------------------------

SHAPES = {"q": (DIMS, DIMS), "k": (DIMS, DIMS), "v": (DIMS, DIMS), "o": (2 * DIMS + 1, CLASSES)}
ENDS = np.cumsum([int(np.prod(x)) for x in SHAPES.values()]).tolist()
SIZE = ENDS[-1]


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    return {name: flat[a:b].reshape(shape) for (name, shape), a, b in zip(SHAPES.items(), [0, *ENDS], ENDS)}


#: _CAUSAL[t, s]: 1 where step t may see the id before step s.
_CAUSAL = np.tri(WINDOW, dtype=np.float32)


def first_weights() -> np.ndarray:
    rng, flat = np.random.default_rng(3), np.zeros(SIZE, np.float32)
    w = unpack(flat)
    for name in "qk":
        w[name][:] = rng.normal(0, 0.1, (DIMS, DIMS))
    w["v"][:] = np.eye(DIMS)
    return flat


class Layer:
    """One masked attention head over id vectors and the class scores it gives.

    ``at`` picks, for every window, the steps that are asked about (padded with any step).
    ``valid`` marks a window's own steps; None: they come first in each row, so the causal mask
    hides what pads it.  Queries meet the id vectors x themselves: q k' = own (Wq Wk') x' and a v = (a x) Wv, so no window is
    projected.  Every vector has a one behind it, whose sum is the softmax's denominator.
    """

    def __init__(self, flat: np.ndarray, vectors: np.ndarray, mass: np.ndarray, classes: np.ndarray):
        self.w, self.mass, self.classes = unpack(flat), mass, classes
        self.vectors = np.concatenate([vectors, np.ones((len(vectors), 1), vectors.dtype)], 1)

    def attend(self, ids: np.ndarray, valid: np.ndarray | None, at: np.ndarray) -> dict[str, np.ndarray]:
        """What the steps ``at`` of each window see; ids[:, t] precedes step t."""
        w, x = self.w, np.take(self.vectors, ids, 0)
        n, m = at.shape
        own = np.take(x.reshape(-1, DIMS + 1), at + ids.shape[1] * np.arange(n)[:, None], 0)
        q = np.zeros((DIMS + 1, DIMS + 1), own.dtype)
        q[:DIMS, :DIMS] = w["q"] @ w["k"].T * np.float32(DIMS ** -0.5)
        across = np.ascontiguousarray(x.transpose(0, 2, 1))
        a = (own.reshape(-1, DIMS + 1) @ q).reshape(n, m, DIMS + 1) @ across
        np.minimum(a, 15, out=a)
        np.exp(a, out=a)
        a *= np.take(_CAUSAL, at, 0)
        if valid is not None:
            a *= valid[:, None, :]
        c = a @ x
        z = c[..., DIMS:] + np.float32(1e-9)
        c = c[..., :DIMS] / z
        h = np.empty((n, m, 2 * DIMS + 1), own.dtype)
        np.matmul(c.reshape(-1, DIMS), w["v"], out=h.reshape(-1, 2 * DIMS + 1)[:, :DIMS])
        h[..., DIMS:] = own
        return {"x": x, "across": across, "own": own, "a": a, "z": z, "c": c, "h": h}

    def classed(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(s, exp(s), the sum of masses times exp(s)) by class for rows of ``h``."""
        s = h @ self.w["o"]
        np.clip(s, -12, 12, out=s)
        e = np.exp(s)
        return s, e, e @ self.mass

    def gain(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """log p(target's class) less its base, for rows of ``h``."""
        s, _, z = self.classed(h)
        return s[np.arange(len(s)), self.classes[targets]] - np.log(z)

    def gradient(self, ids: np.ndarray, valid: np.ndarray | None, at: np.ndarray, targets: np.ndarray, used: np.ndarray
                 ) -> np.ndarray:
        """Gradient of the mean negative gain over the ``used`` ones of the steps ``at``."""
        f, w = self.attend(ids, valid, at), self.w
        x, c, rows = f["x"], f["c"], f["h"].reshape(-1, 2 * DIMS + 1)
        _, d, z = self.classed(rows)
        d *= self.mass
        d *= (1 / z)[:, None]
        d[np.arange(len(d)), self.classes[targets].ravel()] -= 1
        d *= (used.ravel() / max(used.sum(), 1)).astype(np.float32)[:, None]
        flat = np.zeros(SIZE, np.float32)
        g = unpack(flat)
        g["o"][:] = rows.T @ d
        dh = d @ w["o"][:DIMS].T
        g["v"][:] = c.reshape(-1, DIMS).T @ dh
        dc = np.empty_like(f["own"])
        np.divide((dh @ w["v"].T).reshape(c.shape), f["z"], out=dc[..., :DIMS])
        dc[..., DIMS] = -np.einsum("nmd,nmd->nm", dc[..., :DIMS], c)  # meets the ones: less the mean over what is seen
        da = dc @ f["across"]
        da *= f["a"]
        both = (f["own"].reshape(-1, DIMS + 1).T @ (da @ x).reshape(-1, DIMS + 1))[:DIMS, :DIMS] * DIMS ** -0.5
        g["q"][:], g["k"][:] = both @ w["k"], both.T @ w["q"]
        return flat


def picked(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(at, used): the wanted columns of each row first, padded to the row that has most."""
    n = wanted.sum(1)
    used = np.arange(max(1, int(n.max(initial=0)))) < n[:, None]
    at = np.zeros(used.shape, np.int64)
    at[used] = np.nonzero(wanted)[1]
    return at, used


def padded(batches: Iterator[pa.RecordBatch], nth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, None, at, targets, used) of BATCH windows of a round each; the last may have fewer."""
    def batch(ids: np.ndarray, n: np.ndarray, at: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray | None, ...]:
        most = max(1, int(n.max()))
        return ids, None, at[:, :most], targets[:, :most], steps[:most] < n[:, None]

    kept, steps = [], np.arange(WINDOW)
    for ids, marks, first, low, lens, rounds in windows_of(batches):
        own = np.flatnonzero(rounds == nth)
        valid = steps < lens[own, None]
        place = low[own, None] + np.where(valid, steps, 0)
        wanted = marks[place] & valid & (place >= first[own, None])
        at, used = (np.pad(x, ((0, 0), (0, WINDOW - x.shape[1]))) for x in picked(wanted))
        targets = np.full(wanted.shape, END)
        targets[used] = ids[place[wanted] + 1]
        parts = np.where(valid, ids[place], END), wanted.sum(1), at, targets
        kept = [np.concatenate(x) for x in zip(kept, parts)] if kept else parts
        full = len(kept[0]) // BATCH * BATCH
        yield from (batch(*(x[i:i + BATCH] for x in kept)) for i in range(0, full, BATCH))
        kept = [x[full:] for x in kept]
    if kept and len(kept[0]):
        yield batch(*kept)


def train(texts: DataFrame, vectors: np.ndarray, mass: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rounds of local steps in every task, averaged in a shuffle by weight (SIZE rows come back)."""
    sc = texts.sparkSession.sparkContext
    tables, flat = sc.broadcast((vectors, mass, classes)), first_weights()
    for n in range(ROUNDS):
        def steps(batches: Iterator[pa.RecordBatch], start=flat, n=n) -> Iterator[pa.RecordBatch]:
            own, m, v, t, seen = start.copy(), np.zeros(SIZE, np.float32), np.zeros(SIZE, np.float32), 0, 0
            layer, rate = Layer(own, *tables.value), RATE * 0.5 ** n
            for b in padded(batches, n):
                g = layer.gradient(*b)
                t, seen = t + 1, seen + len(b[0])
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                own -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
            if seen:
                yield pa.record_batch([pa.array(np.arange(SIZE, dtype=np.int32)), pa.array(own.astype(np.float64) * seen),
                                       pa.array(np.full(SIZE, float(seen)))], names=["i", "w", "n"])

        got = (texts.mapInArrow(steps, "i int, w double, n double")
               .groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow())
        if got.num_rows:
            flat = flat.copy()
            flat[got.column("i").to_numpy()] = got.column("w").to_numpy()
    return flat


# --- scoring ----------------------------------------------------------------------------

class Model:
    """Everything that scoring needs; its size is fixed by VOCAB, 2 ** HEAVY and 2 ** KEEP."""

    def __init__(self, base: Base, flat, vectors, mass, classes):
        self.base, self.flat, self.vectors, self.mass, self.classes = base, flat, vectors, mass, classes
        self.token = uuid.uuid4().hex  # tells models apart in workers


class Scorer:
    """Scores texts with a model; remembers a bounded number of words."""

    def __init__(self, model: Model, path: str = RANKS):
        self.model, self.sub = model, Subwords(path, model.base)
        self.layer = Layer(model.flat, model.vectors, model.mass, model.classes)

    def scores(self, texts: list[list[bytes]]) -> Iterator[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: the log probability of its end and its broadcast words; its words'
        recalled shares r; and a and b, with p = a r + b for every word."""
        places = self.sub.places(texts)
        ends = np.cumsum([len(at) for at in places])
        s, *words = self.scored(np.concatenate(places), ends)
        return zip(s.tolist(), *(np.split(x, ends[:-1]) for x in words))

    def scored(self, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """:func:`scores` of texts whose words' places are known, the words of all one after the other."""
        base, n = self.model.base, np.diff(ends, prepend=0)
        gain = self._steps(*self.sub.texts(at, ends))
        last = np.zeros(len(gain), bool)
        last[ends + np.arange(len(ends))] = True
        owner, nth = np.repeat(np.arange(len(ends)), n), np.arange(len(at)) - np.repeat(ends - n, n)
        copied = earlier(owner * (int(at.max(initial=0)) + 1) + at) / np.maximum(nth, 1)
        r = self.sub.recall[at]
        a = np.where(nth > 0, 1 - COPY, 1.0) * np.exp(gain[~last])
        b = a * self.sub.spelled[at] + COPY * copied
        known = ~np.isnan(r)
        s = gain[last] + base.log_end + np.where(n > 0, np.log1p(-COPY), 0.0)
        return s + np.bincount(owner[known], np.log(a[known] * r[known] + b[known]), len(ends)), r, a, b

    def _gains(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """The gains of each text's words and end: overlapping windows, each step scored in one."""
        sizes = np.array([len(ids) - 1 for ids, _ in parts])
        begins = np.zeros(sizes.sum(), bool)
        begins[np.concatenate([steps + b for (_, steps), b in zip(parts, np.cumsum(sizes) - sizes)])] = True
        gains = self._steps(np.concatenate([x for x, _ in parts]), sizes, begins)
        return np.split(gains, np.cumsum([len(s) for _, s in parts])[:-1])

    def _steps(self, ids: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The gains of the wanted steps of all texts; see :meth:`Subwords.texts`."""
        ends = np.cumsum(sizes)
        before = ends - sizes
        # Step i of all texts together follows id i, plus one for every text before its own.
        windows = -(-sizes // SCORED)
        owner = np.repeat(np.arange(len(sizes)), windows)
        first = before[owner] + SCORED * (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows))
        # The wanted steps of a window follow each other: asked[i] of them from nth[i] on.
        wanted, upto = np.flatnonzero(wanted), np.r_[0, np.cumsum(wanted)]
        nth, asked = upto[first], upto[np.minimum(first + SCORED, ends[owner])] - upto[first]
        low = np.maximum(first - CONTEXT, before[owner])
        # Windows that ask about equally many steps go together: little is padded.
        order = np.argsort(asked, kind="stable")
        gains = np.zeros(len(wanted))
        for g in range(0, len(order), 128):
            some = order[g:g + 128]
            used = np.arange(max(1, int(asked[some[-1]]))) < asked[some, None]
            step = np.where(used, nth[some, None] + np.arange(used.shape[1]), nth[some, None].clip(max=len(wanted) - 1))
            place = (low + owner)[some, None]
            at = np.where(used, wanted[step] - low[some, None], 0)
            h = self.layer.attend(ids[np.minimum(place + np.arange(WINDOW), len(ids) - 1)], None, at)["h"]
            gains[step[used]] = self.layer.gain(h[used], ids[(place + at)[used] + 1])
        return gains


_SCORER: list = [None, None]


def scorer_of(shared, path: str) -> Scorer:
    """The worker's own scorer of a broadcast model: later tasks go on with the words it knows."""
    model = shared.value
    if _SCORER[0] != (model.token, path):
        _SCORER[:] = [(model.token, path), Scorer(model, path)]
    return _SCORER[1]


def earlier(at: np.ndarray) -> np.ndarray:
    """How often each entry occurred before."""
    bits = len(at).bit_length()
    both = np.sort((at.astype(np.int64) << bits) + np.arange(len(at)))  # one sort of numbers, by entry and position
    order, entry, nth = both & ((1 << bits) - 1), both >> bits, np.arange(len(at))
    out = np.zeros(len(at))
    out[order] = nth - np.maximum.accumulate(np.where(np.diff(entry, prepend=-1) != 0, nth, 0))
    return out


def learn(docs: DataFrame, modulus: int, remainder: int, path: str = RANKS) -> tuple[Model, DataFrame]:
    """The model, and the written word counts of the training documents."""
    counts = materialise(word_counts(docs, modulus, remainder), "lm-counts")
    base = Base(materialise(step_counts(counts, path), "lm-steps"), WordShares(counts))
    texts = materialise(train_texts(docs, modulus, remainder, path), "lm-texts")
    landmarks = np.argsort(-base.frequency, kind="stable")[:LANDMARKS]
    starts = np.zeros(VOCAB, bool)
    with open(path, "rb") as f:
        starts[[int(b) for a, b in map(bytes.split, f) if base64.b64decode(a)[:1] == b" "]] = True
    starts[END] = True
    vectors, classes = vectors_and_classes(cooccurrence(texts, landmarks), base.frequency, starts)
    mass = base.class_mass(classes)
    flat = train(texts, vectors, mass, classes)
    return Model(base, flat, vectors, mass, classes), counts


def score_documents(docs: DataFrame, modulus: int = 7, remainder: int = 2, path: str = RANKS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    held_out: crc32 of the id as text leaves ``remainder`` modulo ``modulus``; a null id is
    not held out.  Tokens are the words and one end, so null and empty texts have one token.
    base_score: the add-one unigram score of the tokens, by training counts.  score: the
    model's log10 probability of the text.  Repeated rows stay repeated, other columns are
    ignored; an empty table gives an empty table.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model, counts = learn(own, modulus, remainder, path)
    shared = own.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, nth = shared.value, TaskContext.get().partitionId() << 40
        scorer, shares = scorer_of(shared, path), model.base.words
        end = float(np.log10((shares.texts + 1) / shares.space))
        for b in slices(batches):
            codes, ends, distinct = split_words(b.column(1))
            places = scorer.sub.look_up(listed(distinct))[codes]
            s, r, a, c = scorer.scored(places, ends)
            n, rare = np.diff(ends, prepend=0), np.flatnonzero(np.isnan(r))
            owner, ids = np.repeat(np.arange(len(ends)), n), b.column(0).to_pylist()
            rares = np.bincount(owner[rare], minlength=len(ends))
            out = (np.arange(nth, nth + len(ends)), ids, [is_held_out(d, modulus, remainder) for d in ids], n + 1,
                   n - rares + (shares.texts > 0), np.bincount(owner, scorer.sub.unigram[places], len(ends)) + end, s)
            nth += len(ends)
            offsets = pa.array(np.r_[0, np.cumsum(rares)], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (
                distinct.take(pa.array(codes[rare])), *(pa.array(np.log(x[rare]).astype(np.float32)) for x in (a, c)))]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(out, kinds)), *lists], names=names)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "a", "b"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    scored = materialise(own.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
                                        "base_score double, score double, rare array<binary>, a array<float>, b array<float>"), "lm-scores")
    # A rare word holds less than 2 ** -HEAVY of the tokens: no key of this join is frequent.
    shares = model.base.words
    n, tokens = F.coalesce("n", F.lit(0)), F.lit(float(max(shares.tokens, 1)))
    recalled = F.greatest(n - RECALL_DISCOUNT, F.lit(0.0)) / tokens
    parts = (scored.select("row", F.explode(F.arrays_zip(F.col("rare").alias("word"), "a", "b")).alias("x"))
             .select("row", "x.word", "x.a", "x.b").join(shares.few(counts), "word", "left")
             .groupBy("row").agg(F.count("n").alias("more_known"),
                                 F.sum(F.log10((n + 1) / F.lit(float(model.base.words.space)))).alias("more_base"),
                                 F.sum(F.log(F.exp(F.col("a").cast("double")) * recalled + F.exp(F.col("b").cast("double")))).alias("more")))
    return (scored.drop("rare", "a", "b").join(parts, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(shares.tokens).cast("long").alias("train_tokens"),
                    (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
                    ((F.col("score") + F.coalesce("more", F.lit(0.0))) / np.log(10)).alias("score")))
