import random
import zlib

import numpy as np

from tidemark.llm import toxicity


def corpus(n=900, seed=4):
    rnd = random.Random(seed)
    plain = ["".join(rnd.choice("abdegiklmnorstu") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 200))]
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(max(1, len(words) // 40)):
                words[rnd.randrange(len(words))] = "zwix" + rnd.choice(plain)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_learns_held_out_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    for i, _, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.7)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.97
    assert sum(p for p, y in held if y) > 0.85 * sum(y for _, y in held)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    out = []
    for flip in (0, 1):
        lab = [(i, y ^ (flip if zlib.crc32(str(i).encode()) % 3 == 1 else 0)) for i, _, y in rows]
        labels = spark.createDataFrame(lab, "doc_id long, toxic int")
        out.append(sorted((r.doc_id, r.score) for r in toxicity.score_documents(docs, labels).collect()))
    assert out[0] == out[1]


def test_nulls_empties_repeats_and_bad_labels(spark):
    rows = corpus(300)
    odd = [(None, "idiot"), (1005, None), (1006, ""), (1007, "x" * 50_000), (1007, "x" * 50_000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string")
    lab = [(i, y, "a") for i, _, y in rows] + [(None, 1, "a"), (3, None, "a"), (4, 9, "a"), (0, 0, "b")]
    labels = spark.createDataFrame(lab, "doc_id long, toxic int, text string")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1005, 1006)}) == 1
    assert sum(r.doc_id == 1007 for r in got) == 2


def test_one_class_or_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs, none).collect()} == {0}
    assert toxicity.score_documents(docs.limit(0), none).count() == 0
    assert toxicity.keep_clean(docs, none).columns == docs.columns


def test_class_models_are_distributions():
    """Over the characters seen after a context, probabilities sum to at most one."""
    counter = toxicity.Counter()
    counter.add([b"abc", b"abd", b"xbc"], np.array([3.0, 1.0, 2.0]), 0)
    counter.add([b"abz"], np.array([2.0]), 1)
    b = counter.batch()
    model = toxicity.Model(*[c.to_numpy(zero_copy_only=False) for c in b.columns])
    abz, abc = model.log_ratio([b"abz", b"abc"])
    assert abz > 0 > abc
    assert abs(model.log_ratio([b"qqq"])[0]) < 1


def test_scores_do_not_depend_on_partitions(spark):
    rows = corpus(300)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score_documents(docs.repartition(n), labels).collect())
            for n in (1, 6))
    assert a == b
