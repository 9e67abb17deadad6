import random

from tidemark.llm import licenses as L
from tidemark.llm.common import table

SCHEMA = "license string, text string"


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_common_rising_and_close_to_the_best():
    rnd = random.Random(3)
    for _ in range(200):
        b = [rnd.randrange(400) for _ in range(rnd.randint(1, 80))]
        a = [x if rnd.random() < 0.85 else rnd.randrange(400) for x in b for _ in range(rnd.choice([1, 1, 1, 0]))]
        pairs, anchors = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert 0.8 * brute_lcs(a, b) <= len(pairs) <= brute_lcs(a, b)


def test_rising_is_longest():
    rnd = random.Random(1)
    for _ in range(100):
        seq = rnd.sample(range(50), rnd.randint(0, 30))
        got = L.rising(list(enumerate(seq)))
        best = brute_lcs(seq, sorted(seq))
        assert len(got) == best and all(x[1] < y[1] for x, y in zip(got, got[1:]))


def test_finds_mutated_templates(spark):
    rnd = random.Random(7)
    filler = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(400)] + list(L.COMMON)
    rows, want = [], set()
    for i in range(200):
        words = [rnd.choice(filler) for _ in range(rnd.randint(0, 300))]
        if i % 2:
            name, text = L.TEMPLATES[rnd.randrange(len(L.TEMPLATES))]
            notice = text.upper().split() if i % 3 else text.split()
            for _ in range(len(notice) // 12):
                notice[rnd.randrange(len(notice))] = rnd.choice(filler)
            at = rnd.randint(0, len(words))
            words[at:at] = notice
            want.add((i, name))
        rows.append((i, " ".join(words), "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = L.scan_licenses(docs, spark.createDataFrame(L.TEMPLATES, SCHEMA)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert want <= found
    assert {d for d, _ in found} == {d for d, _ in want}
    assert all(0.8 <= r.coverage <= 1 for r in got)


def test_notice_repeated_and_places(spark):
    text = "one two\nReleased under the MIT License.\nReleased under the MIT License.\nthree"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = sorted(tuple(r) for r in L.scan_licenses(docs, spark.createDataFrame(L.TEMPLATES, SCHEMA)).collect())
    assert [(r[1], r[2], r[3], r[4]) for r in got] == [("MIT", 2, 5, 1.0), ("MIT", 7, 5, 1.0)]


def test_nulls_empties_long_and_repeats(spark):
    mit = L.TEMPLATES[3][1]
    rows = [(1, None), (2, ""), (3, "..."), (None, mit), (4, mit), (4, mit), (5, "license " * 50_000 + mit)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    t = spark.createDataFrame(L.TEMPLATES + [(None, "x y"), ("none", None), ("blank", " ")], SCHEMA)
    got = [str(r.doc_id) for r in L.scan_licenses(docs, t).collect() if r.license == "MIT"]
    assert sorted(got) == ["4", "4", "5", "None"]
    assert L.scan_licenses(docs, t.limit(0)).count() == 0
    assert L.scan_licenses(docs.limit(0), t).count() == 0


def test_every_plain_notice_of_the_tables_is_found(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text")
    got = {(r.doc_id, r.license) for r in L.scan_licenses(docs, spark.createDataFrame(L.TEMPLATES, SCHEMA)).collect()}
    want = {(r.doc_id, n) for r in docs.collect() for n, t in L.TEMPLATES[:4] if t in r.text}
    assert want <= got and len(want) > 3
    assert {d for d, _ in got} == {d for d, _ in want}
