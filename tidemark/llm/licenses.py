"""License scans by patience alignment.

Words that occur once in a text and once in a template are anchors; the longest run of
anchors that go up on both sides (patience sorting) is kept, and every gap between them is
aligned the same way, where other words may have become unique.  A gap without such words
is closed by matching equal words at its two ends, then by a longest common subsequence
while it is small.  Coverage is the share of the template's words that were aligned.

A document is looked through once: only places where rare template words gather are
aligned, so texts without license words cost one look-up a word.  Templates are a bounded
table (its size in words is checked before it is sent to the tasks); documents are never
shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words_of

COVERAGE = 0.8
#: A window is aligned when it holds this share of the template's key words.
KEY_SHARE = 0.5
#: Template words sent to the tasks, at most; more raises an error.
MOST_WORDS = 2_000_000
#: A gap without unique words is matched word by word while the product of its sides is below this.
SMALL_GAP = 40_000
REMEMBERED = 400_000
_EDGE = ".,;:!?\"'()[]{}<>*#/\\-_|=+"
#: Words too common to tell a license by (fixed list).
COMMON = frozenset("a an and any as at be by for from has have in is it its no not of on or that the this to was "
                   "with under you your all".split())

#: The templates of the registered query: short notices and the usual headers (fixed values).
TEMPLATES = [
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0-header",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("MIT-permission",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software."),
    ("BSD-redistribution",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer."),
    ("GPL-3.0-header",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
]


class Words:
    """Words as 64-bit numbers: lower case, punctuation at the edges off; bare punctuation is left out."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, places): the words that count and their index among all the text's words."""
        words = words_of(text or "")
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            s = w.decode("utf-8", "replace").lower().strip(_EDGE)
            known[w] = xxhash.xxh64_intdigest(s.encode()) if s else 0
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        at = np.flatnonzero(ids)
        return ids[at], at


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (i, j), sorted by i, in which j rises: patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back.append(piles[p - 1] if p else -1)
        if p == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[p], piles[p] = j, n
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _small(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence of two short lists."""
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    right = np.array(b, np.uint64)
    for i in range(len(a) - 1, -1, -1):
        row = np.maximum(best[i + 1, :-1], np.where(right == np.uint64(a[i]), best[i + 1, 1:] + 1, 0))
        best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j] and best[i, j] == best[i + 1, j + 1] + 1:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list[int], b: list[int]) -> tuple[list[tuple[int, int]], int]:
    """(equal places of two word lists, both rising; how many of them are anchors)."""
    out, anchors = [], 0
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        once = [{w for w, n in Counter(x).items() if n == 1} for x in (a[i0:i1], b[j0:j1])]
        both = once[0] & once[1]
        if not both:
            if (i1 - i0) * (j1 - j0) <= SMALL_GAP:
                out += [(i0 + i, j0 + j) for i, j in _small(a[i0:i1], b[j0:j1])]
            continue
        place = {w: j for j, w in enumerate(b[j0:j1], j0) if w in both}
        found = rising([(i, place[w]) for i, w in enumerate(a[i0:i1], i0) if w in both])
        anchors += len(found)
        out += found
        for (i, j), (k, m) in zip([(i0 - 1, j0 - 1), *found], [*found, (i1, j1)]):
            if k - i > 1 and m - j > 1:
                todo.append((i + 1, k, j + 1, m))
    return sorted(out), anchors


class Scanner:
    """Templates ready for scanning."""

    def __init__(self, templates: list[tuple[str, str]]):
        words = Words()
        self.names = [n for n, _ in templates]
        self.words = [words.of(t)[0].tolist() for _, t in templates]
        plain = {xxhash.xxh64_intdigest(w.encode()) for w in COMMON}
        self.keys = [frozenset(x for x in t if x not in plain) or frozenset(t) for t in self.words]
        self.vocabulary = np.array(sorted(set().union(*self.keys) if self.keys else ()), np.uint64)

    def scan(self, ids: np.ndarray, places: np.ndarray) -> list[tuple[str, int, int, float, int]]:
        """(template, first word, words, coverage, anchors) of each match, template by template."""
        if not len(self.vocabulary) or not len(ids):
            return []
        at = np.searchsorted(self.vocabulary, ids).clip(max=len(self.vocabulary) - 1)
        hits = np.flatnonzero(self.vocabulary[at] == ids)
        if not len(hits):
            return []
        hit_ids, out = ids[hits].tolist(), []
        listed = hits.tolist()
        for name, template, keys in zip(self.names, self.words, self.keys):
            own = [(p, w) for p, w in zip(listed, hit_ids) if w in keys]
            n, need, k, done = len(template), KEY_SHARE * len(keys), 0, -1
            reach = n + n // 2 + 2
            while k < len(own):
                start = own[k][0]
                if start < done:
                    k += 1
                    continue
                seen = {w for p, w in self._until(own, k, start + reach)}
                if len(seen) >= need:
                    low = max(start - n // 2, done, 0)
                    window = ids[low:start + reach].tolist()
                    pairs, anchors = align(window, template)
                    if len(pairs) >= COVERAGE * n:
                        first, last = low + pairs[0][0], low + pairs[-1][0]
                        out.append((name, int(places[first]), int(places[last] - places[first] + 1),
                                    len(pairs) / n, anchors))
                        done = last + 1
                k += 1
        return out

    @staticmethod
    def _until(own: list[tuple[int, int]], k: int, end: int) -> Iterator[tuple[int, int]]:
        while k < len(own) and own[k][0] < end:
            yield own[k]
            k += 1


_OUT = "doc_id long, license string, first_word long, n_words long, coverage double, anchors int"


def scan_licenses(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, license, first_word, n_words, coverage, anchors), one row for each match.

    ``templates``: (license, text); rows with a null, or without a word, match nothing.  A
    template may match several times in a text, never overlapping itself; different
    templates may overlap.  Null and empty texts match nothing.  Repeated rows give repeated
    matches; a null doc_id is kept; other columns are ignored.  Empty tables give an empty
    table.  Templates of more than ``MOST_WORDS`` words in all raise an error.
    """
    spark = docs.sparkSession
    good = templates.select("license", "text").dropna().distinct()
    size = good.agg(F.sum(F.size(F.split("text", r"\s+")))).head()[0] or 0
    if size > MOST_WORDS:
        raise ValueError(f"the templates have {size} words; scan them in parts of at most {MOST_WORDS}")
    shared = spark.sparkContext.broadcast(Scanner([tuple(r) for r in good.orderBy("license", "text").collect()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, scanner = Words(), shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                rows = [(d, *m) for d, t in zip(*(c.to_pylist() for c in b.columns)) for m in scanner.scan(*words.of(t))]
                cols = list(zip(*rows)) if rows else [()] * 6
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["doc_id", "license", "first_word", "n_words", "coverage", "anchors"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _OUT)
