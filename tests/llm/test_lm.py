import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import lm
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents", "doc_id", "text")


@pytest.fixture(scope="module")
def learned(docs):
    return lm.learn(docs, 7, 2)


@pytest.fixture(scope="module")
def scored(docs):
    return {r.doc_id: r for r in lm.score_documents(docs).collect()}


def test_base_columns_equal_brute_force(docs, scored):
    texts = {r.doc_id: r.text.encode().lower().split() for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    c = Counter(w for d, t in texts.items() if not held[d] for w in [*t, None])
    n, v = sum(c.values()), len(c)
    assert len(scored) == len(texts)
    for d, t in texts.items():
        r, tokens = scored[d], [*t, None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d], len(tokens), n)
        assert r.n_known == sum(c[w] > 0 for w in tokens)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    """On 10,000 documents.  The base gives every unknown word of a tiny corpus a large share
    (its shares do not sum to one over words), so it is no yardstick there."""
    rows = lm.score_documents(table(spark, "/root/testdata/sf0.1", "documents", "doc_id", "text")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_scores_equal_the_model_on_whole_counts(docs, learned, scored):
    """The rare words that meet their counts in the join give what the model gives directly."""
    model, counts = learned
    n = {bytes(r.word): r.n for r in counts.where("word IS NOT NULL").collect()}
    rows = docs.limit(40).collect()
    texts = [lm.words_of(r.text) for r in rows]
    for row, words, (s, r, a, b) in zip(rows, texts, lm.Scorer(model).scores(texts)):
        share = np.array([max(n.get(w, 0) - lm.RECALL_DISCOUNT, 0) / model.base.words.tokens for w in words])
        rare = np.isnan(r)
        total = s + np.log(a * share + b)[rare].sum()
        assert math.isclose(total / math.log(10), scored[row.doc_id].score, rel_tol=1e-4)


def test_next_word_probabilities_sum_to_at_most_one(learned):
    model, counts = learned
    words = [bytes(r.word) for r in counts.where("word IS NOT NULL").collect()]
    n = {bytes(r.word): r.n for r in counts.where("word IS NOT NULL").collect()}
    scorer = lm.Scorer(model)
    head = words[:3]
    sums = np.zeros(2)
    for at in range(0, len(words), 500):
        for k, start in enumerate(([], head)):
            texts = [[*start, w] for w in words[at:at + 500]]
            for t, (_, r, a, b) in zip(texts, scorer.scores(texts)):
                share = max(n[t[-1]] - lm.RECALL_DISCOUNT, 0) / model.base.words.tokens
                sums[k] += a[-1] * share + b[-1]
    assert (sums < 1.001).all() and (sums > 0.8).all()


def test_attention_is_causal_and_windows_do_not_matter(learned):
    model, _ = learned
    scorer = lm.Scorer(model)
    words = [b"the", b"of", b"and", b"tion", b"der", b"que"] * 60
    whole = scorer._gains([scorer.sub.text(scorer.sub.places([words])[0])])[0]
    part = scorer._gains([scorer.sub.text(scorer.sub.places([words[:200]])[0])])[0]
    assert np.allclose(whole[:200], part[:200], atol=1e-5)
    two = scorer._gains([scorer.sub.text(p) for p in scorer.sub.places([words[:50], words])])
    assert np.allclose(two[1], whole, atol=1e-5)


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(lm.VOCAB, lm.DIMS))
    mass = rng.random(lm.CLASSES)
    mass /= mass.sum()
    classes = rng.integers(0, lm.CLASSES, lm.VOCAB)
    flat = rng.normal(0, 0.2, lm.SIZE)
    ids, targets = (rng.integers(0, lm.VOCAB, (3, lm.WINDOW)) for _ in range(2))
    valid = np.ones((3, lm.WINDOW), bool)
    valid[1, 40:] = False
    at, used = lm.picked(valid & (rng.random(valid.shape) < 0.4))
    targets = np.take_along_axis(targets, at, 1)

    def loss(x):
        layer = lm.Layer(x, vectors, mass, classes)
        h = layer.attend(ids, valid, at)["h"]
        return -layer.gain(h[used], targets[used]).mean()
    g = lm.Layer(flat, vectors, mass, classes).gradient(ids, valid, at, targets, used)
    for i in rng.choice(lm.SIZE, 60, replace=False):
        step = np.zeros(lm.SIZE)
        step[i] = 1e-4
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-4 - g[i]) < 1e-4


def test_earlier_counts():
    assert lm.earlier(np.array([3, 1, 3, 3, 1, 2])).tolist() == [0, 0, 1, 2, 1, 0]
    assert lm.earlier(np.array([], int)).tolist() == []


def test_nulls_empties_long_and_repeats(spark):
    rows = [(i, f"alpha beta gamma delta w{i}", "x") for i in range(60)]
    rows += [(None, "alpha beta", "x"), (100, None, "x"), (101, "", "x"), (102, "é " * 20_000, "x"), (103, "alpha", "y"), (103, "alpha", "y"),
             (104, "x" * 30_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    got = lm.score_documents(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert not by[None][0].held_out and by[100][0].n_tokens == by[101][0].n_tokens == 1
    assert by[100][0].score == by[101][0].score and by[102][0].n_tokens == 20_001
    assert math.isclose(by[103][0].score, by[103][1].score, rel_tol=1e-6)  # single precision inside
    assert all(math.isfinite(r.score) for r in got)
    assert lm.score_documents(df.limit(0)).count() == 0


def test_training_sees_every_id_once(spark):
    rows = [(i, " ".join(f"word{i} unpronounceable{j}x{'abc' * (j % 40)}" for j in range(i * 7 % 90)) or None) for i in range(60)]
    rows += [(100, "https://example.org/" + "q1w2e3" * 400 + " tail"), (None, "no id")]
    got = lm.train_windows(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 7, 2, lm.RANKS).collect()
    sub = lm.Subwords()
    texts = [(t or "").encode().lower().split() for d, t in rows if not lm.is_held_out(d, 7, 2)]
    want = Counter()
    for at in sub.places(texts):
        want.update(sub.text(at)[0][1:].tolist())
    seen = Counter()
    for r in got:
        assert len(r.ids) == len(r.begins) + 1 <= lm.WINDOW + 1 and 0 <= r.nth < lm.ROUNDS
        new = len(r.begins) if r.ids[0] == lm.END else len(r.begins) - lm.CONTEXT
        assert sum(r.begins[:len(r.begins) - new]) == 0
        seen.update(r.ids[-new:])
    assert seen == want
    assert sum(sum(r.begins) for r in got) == sum(len(t) + 1 for t in texts)


def test_words_are_encoded_together_as_one_by_one():
    """One call a batch; words that hold Unicode spaces or marks keep their own ids."""
    sub, calls = lm.Subwords(), []
    plain = [w.encode() for w in ("the", "'s", "it's", "é1", "12ab", "--", "x" * 3000, "漢字かな", "áb", "🙂🙂", "<|endoftext|>")]
    for words in (plain, [*plain, "a b".encode(), "　".encode(), "c ".encode(), b"d\x1ce", "\u0085f".encode()], [b"\xff\xfe", b"z"]):
        ids, lens = sub.encode(words)
        want = [sub.encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
        assert lens.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            calls.append(name)
            return getattr(self.inner, name)

    sub.encoding = Counted(sub.encoding)
    sub.look_up([b"word%d" % i for i in range(500)])
    assert len(calls) == 1


def test_remembered_words_are_forgotten_whole(monkeypatch):
    monkeypatch.setattr(lm, "REMEMBERED", 50)
    sub = lm.Subwords()
    for at in range(0, 300, 30):
        words = [b"w%d" % i for i in range(at, at + 40)]
        for w, place in zip(words, sub.look_up(words)):
            got = sub.ids[sub.starts[place]:sub.starts[place] + sub.lens[place]]
            assert got.tolist() == sub.encoding.encode_ordinary(" " + w.decode())


def test_cooccurrence_equals_brute_force_and_ids_are_kept_once(spark):
    rows = [(i, " ".join(f"w{(i * j) % 23} tail{j % 5}" for j in range(i * 11 % 150)) or None) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = lm.train_texts(docs, 7, 2, lm.RANKS).cache()
    windows = [r.ids for r in lm.train_windows(docs, 7, 2, lm.RANKS).collect()]
    landmarks = np.array([i for i, _ in Counter(i for w in windows for i in w).most_common(20)])
    got = lm.cooccurrence(texts, landmarks)
    want = np.zeros_like(got)
    for w in windows:
        held = Counter(w)
        for i in held:
            want[i] += [held[i] * held[k] for k in landmarks.tolist()]
    assert (got == want).all()
    steps = sum(np.frombuffer(r.sizes, np.int64).sum() + len(r.sizes) // 8 for r in texts.collect())
    assert sum(len(r.ids) for r in texts.collect()) == 2 * steps


def test_slices_are_bounded_by_bytes():
    b = pa.record_batch([pa.array(["x" * 1000] * 50 + ["y" * 90_000] + ["z"] * 50)], names=["text"])
    got = list(lm.slices(iter([b]), 30, 20_000))
    assert sum((x.column(0).to_pylist() for x in got), []) == b.column(0).to_pylist()
    assert all(x.num_rows == 1 or (x.num_rows <= 30 and x.nbytes <= 20_000) for x in got)
