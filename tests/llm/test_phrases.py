import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import phrases


def brute(rows, least, longest, best, share=80):
    count, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                count.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    out = []
    for lang in total:
        own = {p: n for (x, p), n in count.items() if x == lang and n >= least}
        rows_of = []
        for p, a in own.items():
            if len(p) < 2:
                continue
            if any(len(q) > len(p) and 100 * f >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, f in own.items()):
                continue
            score, _, left, right = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows_of.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_of)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def corpus(n, seed):
    rnd = random.Random(seed)
    words = ["a", "B", "c", "D", "e é", "f\xa0g", "h. i", "j,k", "ab cd ab", "x\ty", "end\n", "Straße", "İ"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60))), rnd.choice(["en", "en", "de", None, "und"])) for i in range(n)]
    return rows + [(None, None, "en"), (5, "", None), (6, "...", "fr"), (7, "a b c " * 400, "en")] + [(8, "same words here now", "de")] * 20


@pytest.mark.parametrize("least,shards,slots", [(3, 4, None), (9, 1, None), (5, 3, 1 << 17)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, shards, slots):
    monkeypatch.setattr(phrases, "BLOCK", 3000)
    rows = corpus(150, least)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, phrase string, k int").repartition(5)
    got = phrases.collocations(docs, least=least, shards=shards, slots=slots, best=25)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, 4, 25)


def test_scans_add_up_in_few_tasks(spark, monkeypatch):
    """Every small file of a shard was a task of its own, which sent all its phrases."""
    plans, write = [], phrases.materialise
    monkeypatch.setattr(phrases, "BLOCK", 300)
    monkeypatch.setattr(phrases, "materialise", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, name))[1])
    rows = corpus(40, 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(9)
    got = phrases.collocations(docs, least=3, best=25)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 4, 25)
    assert len(plans) > 4 and all(f"Coalesce {spark.sparkContext.defaultParallelism}" in p for p in plans)


def test_no_phrase_begins_before_its_subphrases():
    """Slots of pairs that others filled in step 0, while the words were known in step 5 only."""
    hashes = np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = np.array([1, 2, 3, 0])
    reached = np.full(1 << 17, phrases.UNSET, np.uint8)
    reached[next(phrases.levels(at, hashes, reached, 4)).slots[1:]] = 5
    *_, pairs = phrases.levels(at, hashes, reached, 4)
    assert (pairs.k, pairs.act.tolist()) == (2, [6, 6])
    reached[pairs.slots] = 0
    *_, triples = phrases.levels(at, hashes, reached, 4)
    assert (triples.k, triples.act.tolist()) == (3, [6])  # was 1: steps 1 to 5 were taken as counted


@pytest.mark.parametrize("step,longest", [(0, 4), (2, 4), (6, 4), (9, 3), (3, 1)])
def test_scans_count_what_is_under_way_below_the_threshold(step, longest):
    """Place by place as phrase by phrase; slots that all tasks know to be full were counted again in every scan."""
    rnd = np.random.default_rng(step)
    at = rnd.integers(0, 40, 5000)
    hashes = rnd.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    reached = np.where(rnd.random(1 << 17) < 0.8, rnd.integers(0, max(step, 1), 1 << 17), phrases.UNSET).astype(np.uint8)
    want, got = np.zeros(len(reached), int), np.zeros(len(reached), int)
    for x in phrases.levels(at, hashes, reached, longest):
        counting = (x.act <= step) & (step < x.act + 4) & (reached[x.slots] == phrases.UNSET)
        counting[0] &= x.k > 1
        np.add.at(want, x.slots[counting], x.counts[counting])
    for slots in phrases.under_way(at, hashes, reached, step, 4, longest):
        np.add.at(got, slots, 1)
    assert np.array_equal(got, want) and (want.any() or step > 3)


@pytest.mark.parametrize("least", [30, 300])
def test_counts_of_a_block_come_back(least):
    for n in (0, 5, 60_000):
        counts = np.zeros(phrases.SPAN, np.uint16)
        counts[np.random.default_rng(1).permutation(phrases.SPAN)[:n]] = least - 1
        raw, total = phrases._packed(np.flatnonzero(counts), counts, least), np.ones(phrases.SPAN, np.uint16)
        phrases._add_to(total, raw, least)
        assert np.array_equal(total, counts + 1) and len(raw) <= phrases.SPAN * (1 if least < 256 else 2)


def test_slots_follow_the_text(spark):
    """Above 2 GB of text a slot held many rare phrases and the last scan sent nearly all of them; more slots
    were an array of all of them in each task."""
    text = 10 << 30  # of 6 GB of files
    assert phrases.slots_for(text) * 32 >= text
    rows = corpus(40, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = phrases.collocations(docs, least=3, slots=phrases.slots_for(text), best=25)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 4, 25)


def test_no_known_slot_is_missed_or_moved():
    rnd = np.random.default_rng(3)
    known, slots = phrases.Known(1 << 20), rnd.permutation(1 << 20)[:60_000]
    seen = np.full(len(slots), phrases.UNSET, np.uint8)
    for step, part in enumerate(np.array_split(np.arange(len(slots)), 6)):
        assert known.add(slots[part], step) and not known.add(slots[part], step + 1)
        now = phrases.Known(1 << 20, known.packed())[slots]
        assert (now[part] <= step).all() and np.array_equal(now[seen != phrases.UNSET], seen[seen != phrases.UNSET])
        seen = now
    known = phrases.Known(1 << 20)
    assert not known.add(np.array([(1 << 20) - 1]), 0) and known[np.array([(1 << 20) - 1, 5])].tolist() == [0, phrases.UNSET]


@pytest.mark.parametrize("least", [30, 300])
def test_tallies_come_back_from_their_blocks(least):
    rnd = np.random.default_rng(least)
    parts = [rnd.integers(0, 1 << 31, 500), np.array([0, 254, 255, 510, 511, phrases.SPAN - 1, phrases.SPAN, (1 << 31) - 1]),
             rnd.integers(0, 2 * phrases.SPAN, 400_000), np.full(400, 7)]
    want = Counter(np.concatenate(parts).tolist())
    tallies = [phrases._tallied([p.astype(np.uint32) for p in half], None, least) for half in (parts[:2], parts[2:])]
    got, totals = {}, {}
    for block, raw in phrases._blocks(*phrases._tallied(*map(list, zip(*tallies)), least), least):
        assert block not in totals
        phrases._add_to(totals.setdefault(block, np.zeros(phrases.SPAN, np.uint16)), raw, least)
    for block, total in totals.items():
        got |= {block * phrases.SPAN + i: n for i, n in zip(np.flatnonzero(total).tolist(), total[total > 0].tolist())}
    assert got == {slot: min(n, least) for slot, n in want.items()}
    assert list(phrases._blocks(np.zeros(0, np.uint32), np.zeros(0, np.uint16), least)) == []


def test_large_numbers_are_exact(spark):
    """Products beyond 64 bits, and a share that is met exactly."""
    big = 6 * 10 ** 13
    rows = [("en", 1, "a", big + 1), ("en", 1, "b", big), ("en", 1, "c", 99), ("en", 2, "a b", big - 1), ("en", 2, "b c", 50), ("en", 3, "a b c", 40)]
    often = spark.createDataFrame(rows, "lang string, k int, phrase string, n long")
    got = {r.phrase: r.score for r in phrases.scored(often).collect()}
    assert got["a b"] == 2000000 * (big - 1) // (2 * big + 1)
    assert got["a b c"] == min(2000000 * 40 // (big + 1 + 50), 2000000 * 40 // (big - 1 + 99))
    assert {r.phrase: r.most for r in phrases.covered(often).collect()} == {"a b": 40, "b c": 40}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(docs).collect() == []
    docs = spark.createDataFrame([(1, None, None), (2, " ", "en")], "doc_id long, text string, lang string")
    assert phrases.collocations(docs).collect() == []
