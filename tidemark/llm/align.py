"""Cross-tokenizer alignment: groups of tokens that two tokenizers cut at the same bytes.

A text's tokens under A and under B each tile its bytes.  Byte offsets where tokens of both
end cut them into groups.  Any byte range of a text gives a *fragment*: the open prefix (tokens up to
its first common cut), the closed groups, the open suffix (tokens behind its last common
cut).  Fragments form a monoid: joining two of them closes whatever their suffix and prefix
have in common and keeps the rest open.  Because joining is associative, a very long text
is dealt as byte ranges to many tasks and its fragments are joined as a tree.  The two
tokenizers' ranges need not end at the same byte: each ends at a place where that tokenizer
can't merge across (A: before a space or a full stop behind a word; B: between two characters
that no piece holds side by side), so tokens of a range are those of the whole text.

Within texts and ranges, pieces between single spaces or line ends are fragments that both
tokenizers close; each is encoded once and remembered (bounded), and a text is a sum over its
pieces.  Counts of linked id pairs are made over the whole corpus first; a second pass adds
up every document's numbers from the counts.  The most frequent pairs, a bounded number,
go to the tasks by broadcast, all others are joined.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions

FOLDER = "/opt/tokenizers"
TOKENIZER_A, TOKENIZER_B = f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model"
#: Texts of more bytes are cut into ranges; characters of a range; fragments joined at once.
LONG, RANGE, FAN = 1 << 16, 1 << 15, 8
#: Pairs that are broadcast: the most frequent ones.
COMMON = 1 << 20
#: A pair's key is its A id above its B id in so many bits.
LOW = (1 << 32) - 1
#: Pieces that a worker remembers.
REMEMBERED = 300_000
MARK = "▁"
#: How a byte-level vocabulary cuts a text before it merges (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
_ROW = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_FRAGMENT = "row long, doc_id long, part long, parts long, fragment binary"
_RARE = "array<struct<a:int,b:int,n:long>>"
_OUT = f"{_ROW}, n_best long, count_sum long, rare {_RARE}"


def _numbers(values) -> np.ndarray:
    return np.asarray(values, np.int64)


@dataclass
class Tokens:
    """Tokens of both tokenizers: ids and the byte offsets at which they end."""

    a: np.ndarray = field(default_factory=lambda: _numbers([]))
    a_ends: np.ndarray = field(default_factory=lambda: _numbers([]))
    b: np.ndarray = field(default_factory=lambda: _numbers([]))
    b_ends: np.ndarray = field(default_factory=lambda: _numbers([]))

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(p) for p in ((self.a, other.a), (self.a_ends, other.a_ends),
                                                    (self.b, other.b), (self.b_ends, other.b_ends))))

    def slice(self, a0: int, a1: int | None, b0: int, b1: int | None) -> Tokens:
        return Tokens(self.a[a0:a1], self.a_ends[a0:a1], self.b[b0:b1], self.b_ends[b0:b1])


_SHOWN: dict[str, np.ndarray] = {}


def _shown(ids: np.ndarray, end: str) -> np.ndarray:
    """Each id's decimal digits and ``end``, as strings."""
    have = _SHOWN.get(end, np.zeros(0, object))
    top = int(ids.max(initial=-1)) + 1
    if len(have) < top:
        have = _SHOWN[end] = np.concatenate([have, np.array([f"{i}{end}" for i in range(len(have), 2 * top)], object)])
    return have[ids]


def _ends(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(all ends, the ends that both have), in order; two sorted runs merge in one stable sort."""
    both = np.sort(np.concatenate([t.a_ends, t.b_ends]), kind="stable")
    twice = both[1:] == both[:-1]
    return both[np.concatenate([[True], ~twice])[:len(both)]], both[1:][twice]


def _linked(t: Tokens, ends: np.ndarray) -> np.ndarray:
    """A key (A id, B id) for every pair of tokens whose byte ranges overlap.

    Between two neighbouring ends lies exactly one token of each; every step over an end
    changes the pair, so these stretches are the links.
    """
    return t.a[np.searchsorted(t.a_ends, ends)] << 32 | t.b[np.searchsorted(t.b_ends, ends)]


def _group_texts(t: Tokens, cuts: np.ndarray) -> list[str]:
    """Strings that join to ``a1,a2|b1;a3|b2;``, one for each token."""
    of_a, of_b = np.searchsorted(cuts, t.a_ends), np.searchsorted(cuts, t.b_ends)
    at_a = np.arange(len(t.a)) + np.searchsorted(of_b, of_a, side="left")
    at_b = np.arange(len(t.b)) + np.searchsorted(of_a, of_b, side="right")
    out = np.empty(len(t.a) + len(t.b), object)
    out[at_a] = np.where(cuts[of_a] == t.a_ends, _shown(t.a, "|"), _shown(t.a, ","))
    out[at_b] = np.where(cuts[of_b] == t.b_ends, _shown(t.b, ";"), _shown(t.b, ","))
    return out.tolist()


@dataclass
class Closed:
    """Groups that are complete: their numbers, their text (each ended by ``;``) and a key for each link."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    texts: list[str] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def of(tokens: Tokens, cuts: np.ndarray) -> Closed:
        """The groups of tokens that begin at a cut and end at the last of ``cuts``."""
        if not len(cuts):
            return Closed()
        return Closed(len(tokens.a), len(tokens.b), len(cuts), ["".join(_group_texts(tokens, cuts))],
                      [_linked(tokens, _ends(tokens)[0])])

    def __add__(self, other: Closed) -> Closed:
        return Closed(self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups,
                      self.texts + other.texts, self.keys + other.keys)

    def text(self) -> str:
        return "".join(self.texts)[:-1]

    def links(self) -> np.ndarray:
        return np.concatenate([_numbers([]), *self.keys])


@dataclass
class Fragment:
    """A byte range's part of the alignment; without a common cut all its tokens are in ``head``."""

    head: Tokens = field(default_factory=Tokens)
    closed: Closed = field(default_factory=Closed)
    tail: Tokens = field(default_factory=Tokens)
    cut: bool = False
    ok: bool = True

    @staticmethod
    def of(tokens: Tokens, ok: bool = True) -> Fragment:
        """The fragment of some consecutive tokens."""
        cuts = _ends(tokens)[1]
        if not len(cuts):
            return Fragment(tokens, ok=ok)
        a0, a1 = np.searchsorted(tokens.a_ends, cuts[[0, -1]], side="right")
        b0, b1 = np.searchsorted(tokens.b_ends, cuts[[0, -1]], side="right")
        return Fragment(tokens.slice(0, a0, 0, b0), Closed.of(tokens.slice(a0, a1, b0, b1), cuts[1:]),
                        tokens.slice(a1, None, b1, None), True, ok)

    def __add__(self, other: Fragment) -> Fragment:
        ok = self.ok and other.ok
        meet = Fragment.of((self.tail if self.cut else self.head) + other.head)
        if not self.cut and not other.cut:
            return Fragment(meet.head, meet.closed, meet.tail, meet.cut, ok)
        closed = meet.closed
        if self.cut:
            if not meet.cut:
                return Fragment(self.head, self.closed, meet.head, True, ok)
            # What meets begins at a cut, so its first group is complete as well.
            closed = self.closed + Closed.of(meet.head, meet.head.a_ends[-1:]) + closed
        head = self.head if self.cut else meet.head
        if other.cut:
            return Fragment(head, closed + other.closed, other.tail, True, ok)
        return Fragment(head, closed, meet.tail, True, ok)

    def whole(self) -> Closed | None:
        """All groups, if this is the fragment of a whole text; None if its bytes didn't survive."""
        if not self.ok or not self.cut or len(self.tail.a) or len(self.tail.b):
            return None
        return Closed.of(self.head, self.head.a_ends[-1:]) + self.closed


class Tokenizers:
    """Both tokenizers and the places where a text may be cut for each."""

    def __init__(self, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B):
        import sentencepiece

        self.encode_a, self.a_bytes = byte_level(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (_numbers([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.side_by_side = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        #: Texts may be cut at all: no piece goes on behind a line end or joins a word to the next.
        self.cuts = not any("\n" in p or p[1] == MARK != p[0] for p in self.side_by_side)

    def ids_a(self, parts: list[str]) -> list[list[int]]:
        return list(map(self.encode_a, parts))

    def ids_b(self, parts: list[str]) -> list[list[int]]:
        """Ids under B of parts of a text that begin where B may be cut."""
        # B adds a space itself; a line end merges with nothing, so behind one it adds none.
        spaced = [p[:1] == " " != p for p in parts]
        ids = self.b.encode([p[1:] if s else "\n" + p for p, s in zip(parts, spaced)])
        return [i if s else i[2:] for i, s in zip(ids, spaced)]

    def survives(self, ids_a: list[int], ids_b: list[int], part_a: str, part_b: str) -> bool:
        """Whether both tokenizers give their part back byte by byte."""
        return (b"".join(map(self.a_bytes.__getitem__, ids_a)) == part_a.encode()
                and b"".join(map(self.b_bytes.__getitem__, ids_b)) == part_b.encode())

    def tokens(self, ids_a, ids_b, at_a: int = 0, at_b: int = 0) -> Tokens:
        a, b = _numbers(ids_a), _numbers(ids_b)
        return Tokens(a, at_a + np.cumsum(self.a_sizes[a]), b, at_b + np.cumsum(self.b_sizes[b]))

    #: A's words end before a single space or line end, and before a full stop behind a letter.
    _SAFE_A = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=[A-Za-zÀ-ÖØ-öぁ-ゖァ-ヺ一-龥])(?=[.,;:!?])")

    def next_cut_a(self, text: str, at: int) -> int:
        found = self._SAFE_A.search(text, at) if self.cuts else None
        return found.start() if found else len(text)

    def next_cut_b(self, text: str, at: int) -> int:
        if not self.cuts:
            return len(text)
        while at < len(text) and text[at - 1:at + 1].replace(" ", MARK) in self.side_by_side:
            at += 1
        return at

    def ranges(self, text: str, size: int) -> list[tuple[int, int, int, int]]:
        """(A from, A to, B from, B to) in characters, for ranges of about ``size`` characters."""
        cuts = [(0, 0)]
        for at in range(size, len(text), size):
            a, b = self.next_cut_a(text, max(at, cuts[-1][0])), self.next_cut_b(text, max(at, cuts[-1][1]))
            if a < len(text) and b < len(text) and (a, b) != cuts[-1]:
                cuts.append((a, b))
        cuts.append((len(text), len(text)))
        return [(*x, *y) for x, y in zip(cuts, cuts[1:])]

    def fragment(self, text: str, a0: int, b0: int, a1: int, b1: int, at: int = 0) -> Fragment:
        """The fragment of one range; ``at`` is the byte offset of the text's first character."""
        part_a, part_b = text[a0:a1], text[b0:b1]
        ids_a, ids_b = self.encode_a(part_a), self.ids_b([part_b])[0] if part_b else []
        if not self.survives(ids_a, ids_b, part_a, part_b):
            return Fragment(ok=False)
        return Fragment.of(self.tokens(ids_a, ids_b, at + len(text[:a0].encode()), at + len(text[:b0].encode())))


def byte_level(path: str):
    """(encoder of a text, the bytes of every id) of a byte-level BPE given as JSON.

    Ids of such a vocabulary are in the order in which its merges were made, which is what
    a rank encoder needs; other vocabularies raise ValueError.  Special tokens' strings in a
    text are plain text.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    before, model = stored["pre_tokenizer"], stored["model"]
    special = {t["content"] for t in stored["added_tokens"]}
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # shown as themselves, all other bytes from U+0100 on
    shown = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)}
    ids = {bytes(map(shown.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merges]
    if before["type"] != "ByteLevel" or before["add_prefix_space"] or stored["normalizer"] or order != sorted(set(order)):
        raise ValueError(f"{path}: not a plain byte-level BPE in merge order")
    encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
    texts = [t.encode() for t, _ in sorted(model["vocab"].items(), key=lambda x: x[1])]
    for t, i in ids.items():
        texts[i] = t
    return encoding.encode_ordinary, texts


class Pieces:
    """Remembered pieces: numbers, group text and linked pairs of each, by piece number."""

    _CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.plain, self.other = {}, {}
        self.numbers = np.zeros((0, 4), np.int64)
        self.bad = np.zeros(0, bool)
        self.texts: list[str] = []
        self.starts, self.pool = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.texts) > REMEMBERED

    def of(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Numbers of the pieces of a space and each text; None for null and empty texts."""
        parted = [self.parts(t) if t else ((), self.plain) for t in texts]
        for known in (self.plain, self.other):
            new = set().union(*(p for p, k in parted if k is known)).difference(known)
            if new:
                first, new = len(self.texts), sorted(new)
                self.learn([(p if p[0] == "\n" else " " + p) for p in new] if known is self.plain else new)
                known.update(zip(new, range(first, len(self.texts))))
        return [np.fromiter(map(known.__getitem__, p), np.int64, len(p)) if p else None for p, known in parted]

    def parts(self, text: str) -> tuple[list[str], dict[str, int]]:
        """The pieces, and where they are known: those of plain texts without their first space."""
        parts = text.replace("\n", " \n").split(" ")
        if self.tokenizers.cuts and len(parts) == len(text.split()) and "" not in parts and "\n" not in parts:
            return parts, self.plain  # white space is single spaces and line ends between words
        return (self._CUT.split(" " + text) if self.tokenizers.cuts else [" " + text]), self.other

    def learn(self, parts: list[str]) -> None:
        t = self.tokenizers
        ids_a, ids_b = t.ids_a(parts), t.ids_b(parts)
        bad = np.zeros(len(parts), bool)
        if not t.survives(list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b)), "".join(parts), "".join(parts)):
            for i, (a, b, p) in enumerate(zip(ids_a, ids_b, parts)):
                if not t.survives(a, b, p, p):
                    bad[i], ids_a[i], ids_b[i] = True, [], []
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(parts)) for x in (ids_a, ids_b))
        tokens = t.tokens(list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b)))
        ends = np.concatenate([[0], tokens.a_ends])[np.cumsum(n_a)]  # of the pieces, in bytes
        every, cuts = _ends(tokens)
        keys = _linked(tokens, every)

        def each(sorted_ends: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(sorted_ends, ends, side="right"), prepend=0)

        n_links = each(every)
        texts, low = _group_texts(tokens, cuts), 0
        for size in (n_a + n_b).tolist():
            self.texts.append("".join(texts[low:low + size])[:-1])
            low += size
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, each(cuts), n_links], 1)])
        self.bad = np.concatenate([self.bad, bad])
        self.pool = np.concatenate([self.pool, keys])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(n_links)])


_HELD: dict[tuple[str, str], Pieces] = {}


def _pieces(paths: tuple[str, str]) -> Pieces:
    """The worker's remembered pieces (results don't depend on what is remembered)."""
    if paths not in _HELD:
        _HELD[paths] = Pieces(Tokenizers(*paths))
    return _HELD[paths]


def _texts(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[list[dict]]:
    for b in batches:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size).to_pylist()


def _pair_counts(paths: tuple[str, str]):
    """Counts of linked pairs over a task's texts: (a, b, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _pieces(paths)
        seen = np.zeros(0, np.int64)

        def done() -> pa.RecordBatch:
            weights = np.repeat(seen, np.diff(held.starts)[:len(seen)])
            keys, at = np.unique(held.pool[:len(weights)], return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, at, weights)
            keys, n = keys[n > 0], n[n > 0]
            return pa.record_batch([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & LOW).astype(np.int32)),
                                    pa.array(n)], names=["a", "b", "n"])

        for rows in _texts(batches):
            if held.full():
                yield done()
                held.clear()
                seen = np.zeros(0, np.int64)
            own = [x for x in held.of([r["text"] for r in rows]) if x is not None and not held.bad[x].any()]
            seen = np.concatenate([seen, np.zeros(len(held.texts) - len(seen), np.int64)])
            if own:
                seen += np.bincount(np.concatenate(own), minlength=len(seen))
        yield done()
    return run


class Known:
    """The broadcast counts: keys of common pairs in order, their counts, every B id's highest count."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, best: np.ndarray):
        self.keys, self.n, self.best = keys, n, best

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, is its B id's highest, is known) of each pair; unknown pairs count 0."""
        if not len(self.keys):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool), np.zeros(len(pairs), bool)
        at = np.searchsorted(self.keys, pairs).clip(max=len(self.keys) - 1)
        known = self.keys[at] == pairs
        n = np.where(known, self.n[at], 0)
        return n, known & (n == self.best[pairs & LOW]), known


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    rare = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))
    names = [c.split()[0] for c in _OUT.replace(_RARE, "x").split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string(), pa.int64(), pa.int64(), rare]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _counted(keys: np.ndarray) -> list[dict]:
    """Each key once, with the number of times it is there."""
    return [{"a": k >> 32, "b": k & LOW, "n": n} for k, n in zip(*(x.tolist() for x in np.unique(keys, return_counts=True)))]


def _finish(paths: tuple[str, str], known) -> object:
    """Every text's row, from its pieces' numbers and the broadcast counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = _pieces(paths), known.value
        per = np.zeros((0, 3), np.int64)  # by piece: links at their B id's highest, sum of counts, unknown links

        def extend(per: np.ndarray) -> np.ndarray:
            if len(per) == len(held.texts):
                return per
            low = held.starts[len(per)]
            n, best, found = counts.look_up(held.pool[low:])
            sums = np.zeros((len(n) + 1, 3), np.int64)
            np.cumsum(np.stack([best, n, ~found], 1).astype(np.int64), axis=0, out=sums[1:])
            return np.concatenate([per, np.diff(sums[held.starts[len(per):] - low], axis=0)])

        for rows in _texts(batches):
            if held.full():
                held.clear()
                per = np.zeros((0, 3), np.int64)
            out = []
            own = held.of([r["text"] for r in rows])
            per = extend(per)
            for r, at in zip(rows, own):
                if at is None or held.bad[at].any():
                    out.append((r["row"], r["doc_id"], 0, 0, 0, 0, "", 0, 0, []))
                    continue
                text = ";".join(map(held.texts.__getitem__, at.tolist()))
                best, total, unknown = per[at].sum(0).tolist()
                rare = []
                if unknown:
                    pairs = np.concatenate([held.pool[held.starts[i]:held.starts[i + 1]] for i in at[per[at, 2] > 0].tolist()])
                    rare = _counted(pairs[~counts.look_up(pairs)[2]])
                out.append((r["row"], r["doc_id"], *held.numbers[at].sum(0).tolist(),
                            hashlib.sha256(text.encode()).hexdigest(), best, total, rare))
            yield _batch(out)
    return run


def _cut(paths: tuple[str, str], size: int):
    """Ranges of long texts: each row holds a range's text and where A's and B's parts lie in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _pieces(paths).tokenizers
        names = ["row", "doc_id", "part", "parts", "text", "a0", "a1", "b0", "b1", "at"]
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.int64()] * 5
        for rows in _texts(batches, 1):
            for r in rows:
                text, at, before = " " + r["text"], 0, 0
                ranges = tokenizers.ranges(text, size)
                for part, (a0, b0, a1, b1) in enumerate(ranges):
                    low, high = min(a0, b0), max(a1, b1)
                    at += len(text[before:low].encode())
                    before = low
                    row = (r["row"], r["doc_id"], part, len(ranges), text[low:high], a0 - low, a1 - low, b0 - low, b1 - low, at)
                    yield pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds)], names=names)
    return run


_RANGES = ("row long, doc_id long, part long, parts long, text string, a0 long, a1 long, b0 long, b1 long, at long")


def _fragments(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _pieces(paths).tokenizers
        for rows in _texts(batches, 16):
            made = [pickle.dumps(tokenizers.fragment(r["text"], r["a0"], r["b0"], r["a1"], r["b1"], r["at"])) for r in rows]
            yield pa.record_batch([pa.array([r[c] for r in rows], pa.int64()) for c in ("row", "doc_id", "part", "parts")]
                                  + [pa.array(made, pa.binary())], names=["row", "doc_id", "part", "parts", "fragment"])
    return run


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """A few neighbouring fragments as one."""
    rows = rows.sort_values("part")
    whole = Fragment()
    for raw in rows["fragment"]:
        whole = whole + pickle.loads(raw)
    first = rows.iloc[:1].copy()
    first["fragment"] = [pickle.dumps(whole)]
    first["part"] = first["part"] // FAN
    return first[["row", "doc_id", "part", "parts", "fragment"]]


def long_documents(docs: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs) of long texts: their ranges are
    dealt to tasks, fragments are joined as a tree of ``FAN`` branches; pairs: (a, b, n) of a text."""
    cut = docs.mapInArrow(_cut(paths, size), _RANGES)
    dealt = cut.repartition(shuffle_partitions(docs.sparkSession), "row", "part")
    parts = materialise(dealt.mapInArrow(_fragments(paths), _FRAGMENT), "align-fragments")
    most = parts.agg(F.max("parts")).first()[0] or 1
    # A null id is kept out of pandas, which would turn the ids beside it into floats.
    ids = parts.where("part = 0").select("row", F.col("doc_id").alias("id"))
    parts = parts.withColumn("doc_id", F.lit(0).cast("long"))
    while most > 1:
        parts = parts.groupBy("row", F.expr(f"part div {FAN}")).applyInPandas(_joined, _FRAGMENT)
        most = -(-most // FAN)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))
        kinds = [pa.int64()] * 5 + [pa.string(), kind]
        for rows in _texts(batches, 16):
            out = []
            for r in rows:
                closed = pickle.loads(r["fragment"]).whole()
                if closed is None:
                    out.append((r["row"], 0, 0, 0, 0, "", []))
                    continue
                digest, keys = hashlib.sha256(closed.text().encode()).hexdigest(), closed.links()
                out.append((r["row"], closed.n_a, closed.n_b, closed.n_groups, len(keys), digest, _counted(keys)))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                  names=["row", *_NUMBERS, "groups_sha256", "pairs"])

    closed = parts.mapInArrow(close, f"row long, {', '.join(f'{c} long' for c in _NUMBERS)}, groups_sha256 string, pairs {_RARE}")
    return closed.join(ids, "row").select("row", F.col("id").alias("doc_id"), *_NUMBERS, "groups_sha256", "pairs")


def _finish_long(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = known.value
        for rows in _texts(batches, 16):
            out = []
            for r in rows:
                keys = np.array([p["a"] << 32 | p["b"] for p in r["pairs"]], np.int64)
                own = np.array([p["n"] for p in r["pairs"]], np.int64)
                n, best, found = counts.look_up(keys)
                out.append((r["row"], r["doc_id"], *(r[c] for c in _NUMBERS), r["groups_sha256"], int(own[best].sum()),
                            int((own * n).sum()), [p for p, f in zip(r["pairs"], found.tolist()) if not f]))
            yield _batch(out)
    return run


def linked_documents(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B, common: int = COMMON,
                     long: int = LONG, size: int = RANGE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    A link is a pair of an A and a B token whose byte ranges overlap; a pair of ids counts how
    many links of the corpus hold it.  n_best: links whose count is the highest of their B
    id (ties included); count_sum: the counts summed over links.  Null and empty texts, and
    texts that a tokenizer does not give back byte by byte, have no tokens: zeros and ''.
    Repeated rows and ids stay; each counts.  Other columns are ignored; an empty table
    gives an empty table.
    """
    spark = docs.sparkSession
    paths = (path_a, path_b)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    bytes_of = F.coalesce(F.octet_length("text"), F.lit(0))
    short = rows.where(bytes_of <= long)
    far = materialise(long_documents(rows.where(bytes_of > long), paths, size), "align-long")
    pairs = (short.select("text").mapInArrow(_pair_counts(paths), "a int, b int, n long")
             .unionByName(far.select(F.explode("pairs").alias("p")).select("p.*")))
    counts = materialise(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), "align-counts")

    highs = counts.groupBy("b").agg(F.max("n").alias("high")).collect()  # a row for each id of B at most
    best = np.zeros(max([r.b for r in highs], default=0) + 1, np.int64)
    for r in highs:
        best[r.b] = r.high
    every = counts.count()
    top = (counts if every <= common else counts.orderBy(F.desc("n"), "a", "b").limit(common)).toArrow()
    keys = top.column("a").to_numpy().astype(np.int64) << 32 | top.column("b").to_numpy()
    order = np.argsort(keys)
    known = spark.sparkContext.broadcast(Known(keys[order], top.column("n").to_numpy()[order], best))

    found = (short.mapInArrow(_finish(paths, known), _OUT)
             .unionByName(far.withColumn("row", -1 - F.col("row")).mapInArrow(_finish_long(known), _OUT)))
    names = ["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"]
    if every <= common:
        return found.select(names)
    found = materialise(found, "align-found")
    highest = counts.groupBy("b").agg(F.max("n").alias("high"))
    judged = counts.join(highest, "b").select("a", "b", F.col("n").alias("count"), (F.col("n") == F.col("high")).alias("is_best"))
    rest = (found.select("row", F.explode("rare").alias("p")).select("row", "p.*").join(judged, ["a", "b"])
            .groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("more_best"),
                                F.sum(F.col("n") * F.col("count")).alias("more_sum")))
    return (found.join(rest, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(names))
