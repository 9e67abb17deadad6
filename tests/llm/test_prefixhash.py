import hashlib
import random

from tidemark.llm import prefixhash as P


def brute(rows):
    """Expected rows, documents in descending id (None last), ties told apart by the caller."""
    out = {}
    for i, (d, t) in enumerate(rows):
        t, u = t or "", rows[(i + 1) % len(rows)][1] or ""
        h = len(t) // 2
        e = t[:len(t) - h] + u[:h]
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), brute_shared(t, e), brute_shared(t, u))
    return out


def check(spark, rows, parts=5):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, bucket int").repartition(parts)
    got = P.fingerprint_documents(docs).collect()
    want = brute(sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0))))
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) == want[r.doc_id], r
    by = {}
    for r in got:
        by.setdefault(r.fingerprint, set()).add(dict(rows)[r.doc_id] or "")
    assert all(len(x) == 1 for x in by.values())


def test_documents_equal_brute_force(spark):
    rnd = random.Random(4)
    alphabet = "abé漢😀 \n"
    rows = [(i * 3 - 50, "".join(rnd.choice(alphabet) for _ in range(rnd.choice([0, 1, 2, 3, 40, 300])))) for i in range(400)]
    rows += [(5000, None), (5001, "same"), (5002, "same"), (5003, "x" * 70_000), (None, "no id")]
    check(spark, rows)


def test_one_row_two_rows_none(spark):
    check(spark, [(7, "abcdef")])
    check(spark, [(7, "abcdef"), (9, "")])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.fingerprint_documents(docs).count() == 0


def test_repeated_ids_stay(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (2, "d"), (None, "e"), (None, "e")], "doc_id long, text string")
    got = P.fingerprint_documents(docs).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 0, 1, 1, 1, 2]


def test_spans_and_extensions():
    rnd = random.Random(9)
    a, b = ("".join(rnd.choice("ab") for _ in range(300)) for _ in range(2))
    x, y = P.PrefixHash.of(P.code_points(a)), P.PrefixHash.of(P.code_points(b))
    for _ in range(2000):
        i, j = rnd.randrange(300), rnd.randrange(300)
        n = rnd.randint(0, 300 - max(i, j))
        assert x.same(i, y, j, n) == (a[i:i + n] == b[j:j + n])
        want = next((k for k in range(300 - max(i, j)) if a[i + k] != b[j + k]), 300 - max(i, j))
        assert x.common_extension(i, y, j) == want
        assert x.same(i, x, i, n)


def test_leading_zero_code_points_count():
    a, b = (P.PrefixHash.of(P.code_points(t)) for t in ("\0", "\0\0"))
    assert a.fingerprint() != b.fingerprint() and a.at[0][1] != b.at[0][2]


def brute_shared(a, b):
    def covered(x, y):
        m = min(len(x), len(y))
        p = next((k for k in range(m) if x[k] != y[k]), m)
        s = min(next((k for k in range(m) if x[-1 - k] != y[-1 - k]), m), m - p)
        has = {y[j:j + P.SPAN] for j in range(len(y) - P.SPAN + 1)}
        inside = set(range(p)) | set(range(len(x) - s, len(x)))
        for i in range(len(x) - P.SPAN + 1):
            if x[i:i + P.SPAN] in has:
                inside.update(range(i, i + P.SPAN))
        return len(inside)
    return min(covered(a, b), covered(b, a)) / max(len(a), len(b)) if a or b else 1.0


def test_shared_part_resumes_after_differences():
    rnd = random.Random(3)
    hashed = lambda t: P.PrefixHash.of(P.code_points(t))
    words = [f"w{i}é" for i in range(300)]
    base = " ".join(rnd.choice(words) for _ in range(200))
    near, shared = hashed(base).compare(hashed("#" + base[1:-1] + "#"))
    assert near == 0 and shared > 0.99
    for _ in range(60):
        other = list(base)
        for _ in range(rnd.randrange(12)):
            at = rnd.randrange(len(other))
            other[at:at + rnd.randrange(3)] = rnd.choice(["", "x", "yz"])
        other = "".join(other)
        x, y = hashed(base), hashed(other)
        assert x.compare(y) == (x.likeness(y), brute_shared(base, other)) and y.compare(x) == x.compare(y)
    for a, b in [("", ""), ("", "abc"), ("x" * 16, "x" * 1000), ("ab" * 40, "b" + "ab" * 30), ("q" * 15, "r" + "q" * 14), (base, base * 2)]:
        assert hashed(a).compare(hashed(b))[1] == brute_shared(a, b)


def test_near_next_copies_with_two_edits_are_shared(spark):
    text = " ".join(f"word{i}" for i in range(400))
    docs = spark.createDataFrame([(2, text), (1, "A" + text[1:900] + "?" + text[901:-1] + "Z")], "doc_id long, text string")
    got = {r.doc_id: r for r in P.fingerprint_documents(docs).collect()}
    assert got[2].near_next > 0.98 and got[1].near_next == got[2].near_next


def test_large_ids_beside_nulls_and_hot_ids_keep_every_row(spark):
    """Ids above 2^53, which floats can't tell apart, next to nulls; an id with half of all rows."""
    rows = [(2 ** 53 + 1 + 2 * i, f"text {i} " * 5) for i in range(40)] + [(None, "x"), (-2 ** 63, "least"), (2 ** 63 - 1, "most")]
    check(spark, rows, 1)
    rows += [(2 ** 53 + 7, f"hot {i}") for i in range(150)] + [(None, f"none {i}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.fingerprint_documents(docs).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((d or 0, len(t)) for d, t in rows)
    # the edited texts chain all rows once: each text gives its beginning to exactly one other
    tie = {(r.doc_id, r.tie, r.text) for r in docs.selectExpr("doc_id", "xxhash64(text) AS tie", "text").collect()}
    order = sorted(tie, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    texts = [t for _, _, t in order]
    want = []
    for t, u in zip(texts, texts[1:] + texts[:1]):
        h = len(t) // 2
        want.append(hashlib.sha256((t[:len(t) - h] + u[:h]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in got) == sorted(want)
