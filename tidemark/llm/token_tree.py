"""Edit-aware token counts: a segment tree of pre-tokens for each document.

A byte-level BPE never merges across pre-tokens, so a text's token count is a sum over its
pre-tokens.  The tree's leaves hold runs of pre-tokens (their lengths in characters and
their token counts), its inner nodes the sums.  An edit goes down the tree by character
offset, re-splits the text from the pre-token that the edit can reach back to (the edit's
start less ``BACK`` characters, as far as the pattern looks ahead of a pre-token's end)
until the new cuts fall on old ones behind the edit, re-encodes only that region and
updates the sums on the leaves' paths.

The leaves are ordinary columns (``lens``, ``counts``), so trees are kept in a table and
later edits start from them.  Splitting and counting run next to the scan, without a
shuffle.  Each task remembers the counts of pre-tokens it has met (bounded).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's pre-token pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters behind a pre-token's end that the pattern may look at.
BACK = 3
#: Pre-tokens in a leaf when a tree is built; a leaf above CROWDED makes the tree be rebuilt.
LEAF, CROWDED = 32, 256
REMEMBERED = 400_000
EDITS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("insert", T.StringType())]))


class TokenCounter:
    """Token counts of pre-tokens."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("pretokens", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.known = regex.compile(pattern), {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, pretokens: list[str]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        encode = self.encoding.encode_ordinary
        for p in set(pretokens).difference(known):
            known[p] = len(encode(p))
        return [known[p] for p in pretokens]


class TokenTree:
    """Sums of characters and tokens over runs of pre-tokens."""

    def __init__(self, text: str, lens: list[int], counts: list[int], counter: TokenCounter):
        self.text, self.counter = text, counter
        self.reencoded = 0
        self._build(lens, counts)

    @classmethod
    def of(cls, text: str, counter: TokenCounter) -> TokenTree:
        pre = counter.split(text)
        return cls(text, list(map(len, pre)), counter.counts(pre), counter)

    def _build(self, lens: list[int], counts: list[int]) -> None:
        self.leaves = [(lens[i:i + LEAF], counts[i:i + LEAF]) for i in range(0, len(lens), LEAF)] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.leaves += [([], []) for _ in range(self.size - len(self.leaves))]
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (a, b) in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(a), sum(b)
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def flat(self) -> tuple[list[int], list[int]]:
        return [x for a, _ in self.leaves for x in a], [x for _, b in self.leaves for x in b]

    def leaf_at(self, offset: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds the character at ``offset``."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if offset >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def tokens_before(self, offset: int) -> int:
        """Tokens of the pre-tokens that end at or before ``offset``."""
        i, start, total = 1, 0, 0
        while i < self.size:
            i *= 2
            if offset >= start + self.chars[i]:
                start, total = start + self.chars[i], total + self.tokens[i]
                i += 1
        for n, c in zip(*self.leaves[i - self.size]):
            start += n
            if start > offset:
                break
            total += c
        return total

    def edit(self, start: int, end: int, insert: str) -> None:
        """Replace the characters [start, end) by ``insert``; bounds outside the text are clipped."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        shift = len(insert) - (end - start)
        text = self.text[:start] + insert + self.text[end:]
        # Left end: the pre-token that holds the character BACK before the edit.
        first, at = self.leaf_at(max(0, start - BACK - 1))
        lens, keep = self.leaves[first][0], 0
        while keep < len(lens) and at + lens[keep] <= start - BACK:
            at += lens[keep]
            keep += 1
        # New cuts from there on, until one falls on an old cut at or behind the edit's end.
        leaf, k, cut, new, pos = first, keep, at, [], at
        for m in self.counter.pattern.finditer(text, at):
            new.append(m.group())
            pos = m.end()
            old = pos - shift
            while cut < old or k >= len(self.leaves[leaf][0]):
                if k < len(self.leaves[leaf][0]):
                    cut += self.leaves[leaf][0][k]
                    k += 1
                elif leaf + 1 < self.size:
                    leaf, k = leaf + 1, 0
                else:
                    break
            if old >= end and cut == old and pos >= start + len(insert):
                break
        else:
            leaf, k = self.size - 1, len(self.leaves[-1][0])
        self.text = text
        self.reencoded += pos - at
        counts = self.counter.counts(new)
        head, tail = self.leaves[first], self.leaves[leaf]
        lens = head[0][:keep] + list(map(len, new)) + tail[0][k:]
        counts = head[1][:keep] + counts + tail[1][k:]
        self._spread(first, leaf, lens, counts)

    def _spread(self, first: int, last: int, lens: list[int], counts: list[int]) -> None:
        """Put pre-tokens into the leaves first..last and update the sums above them."""
        each = -(-len(lens) // (last - first + 1))
        if each > CROWDED:
            a, b = self.flat_around(first, last)
            self._build(a[0] + lens + b[0], a[1] + counts + b[1])
            return
        touched = set()
        for n, i in enumerate(range(first, last + 1)):
            self.leaves[i] = (lens[n * each:(n + 1) * each], counts[n * each:(n + 1) * each])
            self.chars[self.size + i], self.tokens[self.size + i] = sum(self.leaves[i][0]), sum(self.leaves[i][1])
            touched.add((self.size + i) // 2)
        while touched and 0 not in touched:
            for i in touched:
                self._sum(i)
            touched = {i // 2 for i in touched}

    def flat_around(self, first: int, last: int):
        sides = self.leaves[:first], self.leaves[last + 1:]
        return [([x for a, _ in s for x in a], [x for _, b in s for x in b]) for s in sides]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def token_trees(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, text, lens, counts): each document's pre-tokens in order, a null text as empty.

    Rows stay rows; other columns are ignored; an empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in _slices(batches):
            counter = counter or TokenCounter(path)
            pre = [counter.split(t) for t in b.column(1).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array([list(map(len, p)) for p in pre], pa.list_(pa.int32())),
                                   pa.array([counter.counts(p) for p in pre], pa.list_(pa.int32()))],
                                  names=["doc_id", "text", "lens", "counts"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return own.mapInArrow(run, "doc_id long, text string, lens array<int>, counts array<int>")


def attach_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``trees`` with an array column ``edits`` from rows (doc_id, seq, start, end, insert).

    A document's edits are applied in order of seq, each to the text that the one before
    left.  Documents without edits get a null array; edits of unknown documents are dropped.
    """
    own = (edits.where("doc_id IS NOT NULL").groupBy("doc_id")
           .agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end", "insert"))).alias("e"))
           .select("doc_id", F.transform("e", lambda e: F.struct(
               e.start.cast("int").alias("start"), e.end.cast("int").alias("end"), e.insert.alias("insert"))).alias("edits")))
    return trees.join(own, "doc_id", "left")


def apply_edits(trees: DataFrame, path: str = RANKS) -> DataFrame:
    """``trees`` (with ``edits``) after their edits, with what that took.

    Columns: doc_id, text, lens, counts (of the edited text), n_tokens_before, n_tokens,
    edited_chars, reencoded_chars.  A null array, or a null edit in it, changes nothing; a
    null insert deletes; null bounds are 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in _slices(batches):
            counter, out = counter or TokenCounter(path), []
            for doc_id, text, lens, counts, edits in zip(*(c.to_pylist() for c in b.columns)):
                tree = TokenTree(text, lens, counts, counter)
                before = tree.n_tokens
                for e in edits or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["end"] or 0, e["insert"] or "")
                out.append((doc_id, tree.text, *tree.flat(), before, tree.n_tokens, len(tree.text), tree.reencoded))
            cols = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 4]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    schema = ("doc_id long, text string, lens array<int>, counts array<int>, n_tokens_before long, n_tokens long, "
              "edited_chars long, reencoded_chars long")
    names = [c.split()[0] for c in schema.split(", ")]
    return trees.select("doc_id", "text", "lens", "counts", "edits").mapInArrow(run, schema)


def standard_edits(text: Column) -> Column:
    """Three edits of a text of n characters, as the registered query makes them: its first 40
    characters again at n / 3; 17 characters cut at n / 2; 5 at 2n / 3 replaced."""
    n = F.length(text)
    at = [F.floor(n / 3).cast("int"), F.floor(n / 2).cast("int"), F.floor(2 * n / 3).cast("int")]
    rows = [(at[0], at[0], F.substring(text, 1, 40)), (at[1], at[1] + 17, F.lit("")), (at[2], at[2] + 5, F.lit("'re 42\n x"))]
    return F.array(*[F.struct(s.alias("start"), e.alias("end"), i.alias("insert")) for s, e, i in rows])


def edited_counts(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, edited_tokens, edited_pretokens, edited_chars, reencoded_chars,
    edited_sha256) for every row: token counts before and after :func:`standard_edits`."""
    trees = token_trees(docs, path).withColumn("edits", standard_edits(F.col("text")))
    done = apply_edits(trees, path)
    return done.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), F.col("n_tokens").alias("edited_tokens"),
                       F.size("counts").alias("edited_pretokens"), "edited_chars", "reencoded_chars",
                       F.sha2("text", 256).alias("edited_sha256"))
