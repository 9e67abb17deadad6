import random

import numpy as np
import pyarrow as pa

from tidemark.llm import decontaminate as D
from tidemark.llm.common import table


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence_equals_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randint(1, 90))] for _ in range(2))
        assert D.common_subsequence(D.bit_masks(a), len(a), b) == brute_lcs(a, b)


def fixture():
    """Documents over one vocabulary; some hold an item, whole or with words changed."""
    rnd = random.Random(8)
    common = [f"f{i}" for i in range(30)]
    rare = ["".join(rnd.choice("abcdeginorst") for _ in range(rnd.randint(4, 9))) for _ in range(2500)]
    word = lambda: rnd.choice(common) if rnd.random() < 0.5 else rnd.choice(rare)
    items = [[word() for _ in range(rnd.randint(14, 90))] for _ in range(60)]
    docs, planted = [], set()
    for i in range(500):
        words = [word() for _ in range(rnd.randint(5, 700))]
        if i % 4 == 0:
            n = rnd.randrange(60)
            item = list(items[n])
            for _ in range(len(item) // 8 if i % 8 == 0 else 0):  # a paraphrase: words replaced, added, left out
                at = rnd.randrange(len(item))
                item[at:at + 1] = [[word()], [item[at], word()], []][rnd.randrange(3)]
            at = rnd.randrange(len(words) + 1)
            text = " ".join(words[:at]) + " " + " ".join(item).capitalize() + ". " + " ".join(words[at:])
            planted.add((i, n))
        else:
            text = " ".join(words)
        docs.append((i, text, "x"))
    return docs, [(n, " ".join(x).capitalize() + ".") for n, x in enumerate(items)], planted


def test_finds_planted_items_and_leaves_clean_documents(spark):
    docs, items, planted = fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string").repartition(5)
    got = D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found & planted) >= 0.98 * len(planted)
    assert {d for d, _ in found} <= {d for d, _ in planted}
    exact = {(d, n) for d, n in planted if d % 8}
    assert exact <= found
    clean = D.drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, *_ in docs} - {d for d, _ in found}


def test_candidate_recall_against_exact_cosines(spark):
    """The latent search keeps at least 0.9 of what exact TF-IDF cosines at the same bound find."""
    docs, items, _ = fixture()
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    finder = next(D.prepare(df, spark.createDataFrame(items, "item_id long, text string"))).value
    idf, terms, hit, want = D.inverse_frequencies(df), D.Terms(), 0, 0
    vec = lambda t: np.bincount(D.slots_of(t), minlength=D.SLOTS) * idf
    queries = [(n, vec(t[:64]) / np.linalg.norm(vec(t[:64]))) for n, (_, t, _) in enumerate(finder.items)]
    for _, text in [d[:2] for d in docs[:160]]:
        t = terms.of(text)
        found = {(n, at) for n, at, _, _ in finder.candidates(t)}
        for at in range(0, max(1, len(t) - D.HALF), D.HALF):
            v = vec(t[at:at + 64])
            for n, q in queries:
                if v @ q >= 0.5 * np.linalg.norm(v):
                    want += 1
                    hit += any(m == n and abs(a - at) <= D.HALF for m, a in found)
    assert want > 20 and hit >= 0.9 * want


def test_nulls_empties_repeats_long_texts(spark):
    item = "the quick brown fox jumps over the lazy dog near the old stone bridge tonight. Answer is forty two."
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, item), (1, item), (None, f"so {item}"), (2, None), (3, ""), (4, long), (5, f"{long} {item} {long}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (9, item), (8, None), (7, ""), (None, "a b c")], "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id) for r in D.contaminated(docs, bench).collect())
    assert got == [(-1, 9), (1, 9), (1, 9), (5, 9)]
    assert D.contaminated(docs, bench.limit(0)).count() == 0
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_the_answer_must_be_there(spark):
    stem = " ".join(f"question{i}" for i in range(30))
    docs = spark.createDataFrame([(1, stem + " so the reply: seven green apples"), (2, stem + " nothing more")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, stem + " seven green apples", "seven green apples")],
                                  "item_id long, text string, answer string")
    assert [r.doc_id for r in D.contaminated(docs, bench).collect()] == [1]


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 7)
    docs, items, planted = fixture()
    df = spark.createDataFrame([d[:2] for d in docs[:80]], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in
           D.contaminated(df, spark.createDataFrame(items[:30], "item_id long, text string")).collect()}
    assert {(d, n) for d, n in planted if d < 80 and n < 30 and d % 8} <= got


def test_whole_items_of_the_sample_tables_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text")
    ws = lambda t: b" " + b" ".join(t.encode().lower().split()) + b" "
    texts, items = ({r[0]: ws(r[1]) for r in df.collect()} for df in (docs, bench))
    exact = {(d, i) for d, t in texts.items() for i, q in items.items() if q in t}
    assert exact <= {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}


def test_terms_of_a_block_are_those_of_its_texts(monkeypatch):
    texts = ["A b,\x0bB  «b» Ünder...", None, "", " \t\n", "... , x\x1cy İ! b", "b " * 50, "a1 ÀÉ (a1)"]
    own, seen = D.Terms(), []
    found, ends = own.of_all(pa.array(texts))
    for text, got in zip(texts, np.split(found, ends[:-1]), strict=True):
        assert got.dtype == np.uint64 and got.tolist() == D.Terms().of(text).tolist()
    look_up = D.Terms._look_up
    monkeypatch.setattr(D.Terms, "_look_up", lambda self, words: seen.extend(words) or look_up(self, words))
    D.Terms().of_all(pa.array(texts * 3))
    assert len(seen) == len(set(seen)) > 5  # each distinct word once a block


def test_inverse_frequencies_equal_brute_force(spark):
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(90)}" for _ in range(rnd.choice([0, 1, 31, 32, 33, 64, 200]))) for _ in range(60)] + [None]
    held, total = np.zeros(D.SLOTS), 0
    for text in texts:
        slots = D.slots_of(D.Terms().of(text))
        for at in range(0, len(slots), D.HALF):
            held[np.unique(slots[at:at + D.HALF])] += 1
            total += 1
    got = D.inverse_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert np.array_equal(got, np.log1p((total + 1) / (held + 1)))
