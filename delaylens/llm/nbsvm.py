"""Quality classifier: naive Bayes features in a support vector machine.

Each text becomes indicators of its word 1- and 2-grams and of 1- to 3-grams of word shapes
(capitals, digits, marks, repeats), hashed. Every indicator is scaled by its class log-count ratio,
each text to unit length, and a linear hinge-loss model is fitted by dual coordinate descent in numpy.
Margins become probabilities through a logistic curve on rows the machine was not fitted on.

Learning uses a bounded sample of labelled rows, about ``sample_rows``. Whole texts are scored; a
null text is empty and has only the bias. Labels without an id or value are not used, several for
one id are averaged. Without rows of both labels every score is the share of good labels, or 0.5.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.llm.common import appended, is_held_out, with_fields
from delaylens.llm.kernels import mixed, range_hashes, sequence_hashes, slices, texts_of

BUCKETS = 1 << 18
SAMPLE_ROWS = 8000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12

_KIND = np.full(256, 3, np.uint8)  # 0 lower case, 1 capital, 2 digit, 3 mark
_KIND[97:123] = 0
_KIND[128:] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2


def shapes(data, starts, ends, hashes):
    """Small code of each word: which kinds of characters it has, how it starts, if it repeats."""
    n = len(starts)
    code = np.zeros(n, np.uint64)
    for kind in range(4):
        total = np.concatenate([[0], np.cumsum(_KIND[data] == kind)])
        share = total[ends] - total[starts]
        size = ends - starts
        code = code * np.uint64(4) + np.where(share == 0, 0, np.where(share == 1, 1, np.where(
            2 * share > size, 3, 2))).astype(np.uint64)
    same = np.zeros(n, np.uint64)
    same[1:] = hashes[1:] == hashes[:-1]
    return mixed((code * np.uint64(2) + same) * np.uint64(256) + _KIND[data[starts]] + np.uint64(1))


def indicators(texts, buckets=BUCKETS):
    """(text, bucket) of the distinct features of all texts, ordered by text."""
    starts, ends, first = texts.words()
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = range_hashes(texts.data, starts, ends)
    shape = shapes(texts.data, starts, ends, hashes)
    found = []
    for salt, (values, n) in enumerate([(hashes, 1), (hashes, 2), (shape, 1), (shape, 2), (shape, 3)]):
        grams = sequence_hashes(values, n)
        own = text_of[:len(grams)] == text_of[n - 1:]
        bucket = mixed(grams[own] + np.uint64(salt)) % np.uint64(buckets)
        found.append(text_of[:len(grams)][own] * buckets + bucket.astype(np.int64))
    keys = np.unique(np.concatenate(found))
    return keys // buckets, keys % buckets


class Model:
    def __init__(self, weights, bias, slope, shift):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def margins(self, text, bucket, n):
        """``weights`` holds (ratio, ratio times weight) of each bucket."""
        norm = np.sqrt(np.bincount(text, self.weights[0][bucket] ** 2, minlength=n))
        return np.bincount(text, self.weights[1][bucket], minlength=n) / np.maximum(norm, 1e-9) + self.bias

    def scores(self, text, bucket, n):
        return 1 / (1 + np.exp(-(self.slope * self.margins(text, bucket, n) + self.shift)))


def log_ratios(rows, labels, buckets=BUCKETS, smoothing=SMOOTHING):
    """Class log-count ratio of every bucket."""
    counts = np.full((2, buckets), smoothing)
    for at, y in zip(rows, labels):
        counts[int(y), at] += 1
    share = counts / counts.sum(1, keepdims=True)
    return np.log(share[1] / share[0])


def descend(rows, labels, ratios, cost=COST, epochs=EPOCHS, seed=9):
    """Weights and bias of the L1-loss machine by dual coordinate descent."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(len(ratios)), 0.0
    x = []
    for at in rows:
        v = ratios[at]
        x.append(v / max(np.linalg.norm(v), 1e-9))
    square = np.array([v @ v for v in x]) + 1.0
    alpha = np.zeros(len(rows))
    sign = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (x[i] @ w[rows[i]] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * x[i]
                bias += step
                most = max(most, abs(step))
                alpha[i] = new
        if most < 1e-3:
            break
    return w, bias


def logistic(margins, labels, rounds=50):
    """Slope and shift of a logistic curve by Newton steps, with a weak pull to slope 1."""
    z = np.stack([margins, np.ones_like(margins)], 1)
    p = np.array([1.0, 0.0])
    for _ in range(rounds):
        s = 1 / (1 + np.exp(-np.clip(z @ p, -30, 30)))
        pull = np.array([0.01, 0.01])
        gradient = z.T @ (s - labels) + pull * (p - [1.0, 0.0])
        curve = (z * (s * (1 - s))[:, None]).T @ z + np.diag(pull)
        p = p - np.linalg.solve(curve, gradient)
    return float(p[0]), float(p[1])


def train(rows, labels, seed=9):
    labels = np.asarray(labels, float)
    if not len(rows) or labels.min() == labels.max():
        share = float(labels.mean()) if len(rows) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros((2, BUCKETS)), 0.0, 1.0, float(np.log(share / (1 - share))))
    order = np.random.default_rng(seed).permutation(len(rows))
    held, learn = order[:len(rows) // 4], order[len(rows) // 4:]
    if len(set(labels[learn])) < 2 or not len(held):
        held, learn = order, order
    ratios = log_ratios([rows[i] for i in learn], labels[learn])
    w, bias = descend([rows[i] for i in learn], labels[learn], ratios)
    model = Model(np.stack([ratios, ratios * w]), bias, 1.0, 0.0)
    text = np.repeat(np.arange(len(held)), [len(rows[i]) for i in held])
    margins = model.margins(text, np.concatenate([rows[i] for i in held]), len(held))
    model.slope, model.shift = logistic(margins, labels[held])
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality",
        sample_rows=SAMPLE_ROWS) -> Model:
    """Model learnt from labelled rows that are not held out."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                         & ~is_held_out("doc_id")).groupBy("doc_id").agg(
        (F.avg(label) >= 0.5).cast("int").alias("y"))
    total = marks.count()
    chance = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id").cast("long")), F.lit(1 << 30)) / (1 << 30)
    share = sample_rows / max(total, 1)
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(chance < share)
    sample = picked.join(marks.where(chance < share), "doc_id").limit(2 * sample_rows)

    def featured(batches):
        for batch in slices(batches):
            text_of, bucket = indicators(texts_of(batch.column(1)))
            offsets = pa.array(np.searchsorted(text_of, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.ListArray.from_arrays(offsets, pa.array(bucket.astype(np.int32)))],
                names=["y", "at"])

    got = sample.mapInArrow(featured, "y int, at array<int>").toArrow()
    return train([v.values.to_numpy() for v in got.column(1)], got.column(0).to_pylist())


def score(docs: DataFrame, model: Model, text="text") -> DataFrame:
    """Add ``score`` and ``predicted`` to the rows."""
    schema = with_fields(docs.schema, score=T.DoubleType(), predicted=T.IntegerType())

    def run(batches):
        for batch in slices(batches, text):
            text_of, bucket = indicators(texts_of(batch.column(batch.schema.get_field_index(text))))
            s = model.scores(text_of, bucket, batch.num_rows)
            yield appended(batch, {"score": pa.array(s),
                                   "predicted": pa.array((s >= 0.5).astype(np.int32))})

    return docs.mapInArrow(run, schema)
