"""Toxicity by two class-conditional Kneser-Ney character models.

A word is a chain of characters between a start and an end mark.  Each class (ordinary 0,
toxic 1) has its own counts of the longest n-grams (``ORDER`` 4); all shorter n-grams are
continuation counts over both classes together.  Both class models back off to that one
shared model with interpolated absolute discounting, so a rare expression that neither
class has seen weighs nothing, and a stem seen in one class alone weighs much.

A document's evidence is the difference of its two log-likelihoods divided by its length
in words, taken three ways: whole, and only the part of each word's difference above 2 and
above 4 nats, where chance differences between the two samples do not reach.  A logistic
curve over their signed square roots, fitted on labelled documents that gave no counts,
turns them into a score between 0 and 1.

Learning uses a bounded sample of labelled rows: at most ``PER_CLASS`` (10,000) rows of
each class, those whose hashed ids are smallest.  The sample ids are broadcast (bounded by
that parameter), counting and calibration run as Spark jobs over the sample's texts, and
the model is a fixed number of hashed counters.  Scoring is one Arrow pass over all
documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialise, words_of

#: Characters in the longest n-gram.
ORDER = 4
#: Hashed counters for each order, as a power of two.
BITS = 18
DISCOUNT = 0.75
#: Labelled rows of each class that are learned from, at most.
PER_CLASS = 10_000
#: Share of the sample that calibrates instead of counting: one in so many.
CALIBRATE = 4
#: Nats that a word's difference must exceed, for each feature (first: all of it).
FLOORS = (None, 2.0, 4.0)
#: Words whose difference a task remembers, at most.
REMEMBERED = 250_000
#: From this score on a document is predicted toxic.
THRESHOLD = 0.7
_START, _END = 2, 3


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder`` (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, contexts, owner) of every character step of the given words.

    slots[k] is the hashed n-gram of order k + 1 that ends at the step, contexts[k] the
    hashed k characters before it; owner is the word's index.
    """
    chars = [np.frombuffer(w.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for w in words]
    lens = np.array([len(c) + 1 for c in chars], np.int64)
    pad = ORDER - 1
    total = int((lens + pad).sum())
    flat = np.full(total, _START, np.uint64)
    ends = np.cumsum(lens + pad)
    starts = ends - lens
    owner = np.repeat(np.arange(len(words)), lens)
    step = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(starts, lens)
    body = np.ones(len(step), bool)
    body[np.cumsum(lens) - 1] = False
    flat[step[body]] = np.concatenate(chars) if chars else []
    flat[ends - 1] = _END
    slots, contexts = [], []
    acc = np.zeros(len(step), np.uint64)
    ctx = np.zeros(len(step), np.uint64)
    for k in range(ORDER):
        c = flat[step - k]
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1)
        slots.append(_slot(acc, k))
        contexts.append(_slot(ctx, k) if k else np.zeros(len(step), np.int64))
        if k + 1 < ORDER:
            ctx = ctx * np.uint64(0x9E3779B97F4A7C15) + flat[step - k - 1] + np.uint64(1)
    return np.array(slots), np.array(contexts), owner


def _slot(h: np.ndarray, k: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
    return ((h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - BITS)).astype(np.int64)


class Counter:
    """Hashed n-gram counts of one task: longest order by class, the rest shared."""

    def __init__(self):
        size = 1 << BITS
        self.top = np.zeros((2, size))
        self.seen = np.zeros((ORDER, size), bool)
        # Of two n-grams in one slot the larger context and parent count, in any order of work.
        self.context = np.zeros((ORDER, size), np.int64)
        self.parent = np.zeros((ORDER, size), np.int64)

    def add(self, words: list[bytes], counts: np.ndarray, label: int) -> None:
        slots, contexts, owner = grams(words)
        np.add.at(self.top[label], slots[-1], counts[owner])
        for k in range(ORDER):
            self.seen[k, slots[k]] = True
            np.maximum.at(self.context[k], slots[k], contexts[k])
            if k:
                np.maximum.at(self.parent[k], slots[k], slots[k - 1])

    def batch(self) -> pa.RecordBatch:
        order, slot = np.nonzero(self.seen)
        top = order == ORDER - 1
        c = [np.where(top, self.top[y][slot], 0.0) for y in (0, 1)]
        return pa.record_batch([pa.array(order.astype(np.int32)), pa.array(slot.astype(np.int32)),
                                pa.array(self.context[order, slot].astype(np.int32)),
                                pa.array(self.parent[order, slot].astype(np.int32)),
                                pa.array(c[0]), pa.array(c[1])],
                               names=["k", "slot", "context", "parent", "ordinary", "toxic"])


class Model:
    """Interpolated Kneser-Ney; ``shared[k]`` scores order k + 1, the class tables order ORDER."""

    def __init__(self, k, slot, context, parent, ordinary, toxic):
        size = 1 << BITS
        self.gram = np.zeros((ORDER + 1, size), np.float32)   # discounted share; last two: the classes
        self.rest = np.ones((ORDER + 1, size), np.float32)    # back-off weight of a context
        for order in range(ORDER - 1):
            own, up = k == order, k == order + 1
            left = np.bincount(parent[up], minlength=size).astype(float)  # distinct left extensions
            self._fill(order, slot[own], context[own], left[slot[own]], size)
        top = k == ORDER - 1
        for y, c in enumerate((ordinary, toxic)):
            used = c[top] > 0
            self._fill(ORDER - 1 + y, slot[top][used], context[top][used], c[top][used], size)

    def _fill(self, row, slot, context, count, size):
        total = np.bincount(context, count, size)
        kinds = np.bincount(context, count > 0, size)
        self.gram[row, slot] = np.maximum(count - DISCOUNT, 0) / np.maximum(total[context], 1)
        self.rest[row] = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1)

    def log_ratio(self, words: list[bytes]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) for each word."""
        if not words:
            return np.zeros(0)
        slots, contexts, owner = grams(words)
        low = np.full(len(owner), 1 / 256, np.float32)
        for k in range(ORDER - 1):
            low = self.gram[k][slots[k]] + self.rest[k][contexts[k]] * low
        p = [self.gram[ORDER - 1 + y][slots[-1]] + self.rest[ORDER - 1 + y][contexts[-1]] * low for y in (0, 1)]
        return np.bincount(owner, np.log(p[1]) - np.log(p[0]), len(words))


class Scorer:
    """Features of texts; remembers the difference of the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[bytes, float] = {}

    def features(self, texts: list[str | None]) -> np.ndarray:
        docs = [words_of(t or "") for t in texts]
        new = list({w for ws in docs for w in ws if w not in self.known})
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list({w for ws in docs for w in ws})
        for at in range(0, len(new), 50_000):
            part = new[at:at + 50_000]
            self.known.update(zip(part, self.model.log_ratio(part).tolist()))
        known, out = self.known.__getitem__, np.zeros((len(docs), len(FLOORS)))
        for i, ws in enumerate(docs):
            if ws:
                v = np.fromiter(map(known, ws), float, len(ws))
                out[i] = [v.mean() if f is None else np.maximum(v - f, 0).mean() for f in FLOORS]
        return np.sign(out) * np.sqrt(np.abs(out))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Newton steps for ridge logistic regression; (weights..., bias) on raw features."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    keep = ridge * max(len(y), 1) / 1000
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + keep * np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (y - p) - keep * w)
    return np.r_[w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum()]


def batches_of(items: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in items:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def label_sample(labels: DataFrame, per_class: int, modulus: int, remainder: int) -> DataFrame:
    """(doc_id, toxic, calibrate): at most ``per_class`` rows of each class, smallest hashed
    ids first, none with the held-out remainder.  Rows with a null id or a label other than
    0 and 1 teach nothing; an id labelled twice counts once, as toxic if it ever is."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .where(~held_out(F.col("doc_id"), modulus, remainder))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    picked = [known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    return (picked[0].unionByName(picked[1])
            .withColumn("calibrate", F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATE)) == 0))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, modulus: int = 3,
          remainder: int = 1) -> tuple[Model | None, np.ndarray]:
    """The two class models and the logistic curve, from the labelled sample.

    Without both classes among the counted and the calibrating documents there is no model;
    the curve is then the sample's share of toxic documents, the same for every text.
    """
    sample = materialise(label_sample(labels, per_class, modulus, remainder), "toxicity-sample")
    texts = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                        .join(F.broadcast(sample), "doc_id")
                        .select("text", "toxic", "calibrate"), "toxicity-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for b in batches_of(batches, 2000):
            by: list[dict[bytes, int]] = [{}, {}]
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = by[y]
                for w in words_of(text or ""):
                    own[w] = own.get(w, 0) + 1
            for y in (0, 1):
                counter.add(list(by[y]), np.fromiter(by[y].values(), float, len(by[y])), y)
        yield counter.batch()

    schema = "k int, slot int, context int, parent int, ordinary double, toxic double"
    # At most ORDER * 2 ** BITS rows, whatever the input.
    table = (texts.where("NOT calibrate").select("text", "toxic").mapInArrow(count, schema)
             .groupBy("k", "slot").agg(F.max("context").alias("context"), F.max("parent").alias("parent"),
                                       F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
             .toArrow())
    model = Model(*(table.column(c).to_numpy() for c in table.column_names))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches_of(batches):
            x = scorer.features(b.column(0).to_pylist())
            yield pa.record_batch([b.column(1), *map(pa.array, x.T)], names=["toxic", "x0", "x1", "x2"])

    # At most 2 * per_class rows of four numbers.
    seen = (texts.where("calibrate").select("text", "toxic")
            .mapInArrow(measure, "toxic int, x0 double, x1 double, x2 double").toArrow().to_pandas()
            .sort_values(["toxic", "x0", "x1", "x2"]))
    shares = sample.agg(F.count("*"), F.sum("toxic")).head()
    if not shares[1] or shares[1] == shares[0] or seen["toxic"].nunique() < 2 or not table.num_rows:
        base = (shares[1] or 0) / max(shares[0], 1)
        odds = np.clip(base, 1e-6, 1 - 1e-6)
        return None, np.array([0.0] * len(FLOORS) + [np.log(odds / (1 - odds))])
    return model, fit_logistic(seen[["x0", "x1", "x2"]].to_numpy(), seen["toxic"].to_numpy(float))


def with_score(docs: DataFrame, model: Model | None, curve: np.ndarray, column: str) -> DataFrame:
    """``docs`` with the toxicity score of its text added; a null text scores as an empty one."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast((model, curve))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, curve = shared.value
        scorer = Scorer(model) if model else None
        for b in batches_of(batches):
            x = scorer.features(b.column(at).to_pylist()) if scorer else np.zeros((b.num_rows, len(FLOORS)))
            score = 1 / (1 + np.exp(-np.clip(x @ curve[:-1] + curve[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*b.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1,
                    threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    held_out: crc32 of the id as text leaves ``remainder`` modulo ``modulus`` (null id: no);
    no label of such an id is learned from.  The score comes from the text alone; null and
    empty texts have the score of no evidence.  Repeated rows stay repeated, other columns
    are ignored, and an empty ``docs`` gives an empty table.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    model, curve = learn(own, labels, per_class, modulus, remainder)
    scored = with_score(own, model, curve, "score")
    return scored.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; columns unchanged."""
    model, curve = learn(docs, labels)
    column = fresh("score")
    return with_score(docs, model, curve, column).where(F.col(column) < threshold).drop(column)
