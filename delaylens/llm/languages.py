"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are byte n-grams of lower-cased (A-Z) words with a space on both sides. Each is hashed to a
row of an embedding table; the mean of a text's rows goes through a linear softmax. Table and softmax
are trained together by stochastic gradient descent in numpy on a bounded sample of labelled rows,
about ``per_language`` of each value and ``sample_rows`` in all: every value is learnt, with fewer rows
each where there are many. A fifth of the sample sets the temperature of the probabilities and the
confidence below which a prediction is rejected.

Whole texts are read. Null texts and texts without a letter get ``und`` with score 0. Rows with a
missing label are not learnt from. Without labelled rows every text is ``und``.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.llm.common import appended, is_held_out, with_fields
from delaylens.llm.kernels import mixed, slices, texts_of
from delaylens.llm.substrings import packed

BUCKETS = 1 << 14
SIZES = (2, 3, 4)
DIM = 16
PER_LANGUAGE = 500
SAMPLE_ROWS = 128_000
#: Rows of a value that are drawn at least (all, if it has fewer).
LEAST = 20
EPOCHS = 4
#: Share of right answers wanted of the accepted predictions.
WANTED = 0.99
NONE = "und"


def subwords(texts, buckets=BUCKETS):
    """(bucket of every subword, number of subwords of each text)."""
    low = texts.lowered()
    data, starts, ends, first = packed(low)
    data = np.concatenate([[32], data]).astype(np.uint64)
    space = data == 32
    # a text begins with the space before its first word
    begin = np.concatenate([starts, [len(data) - 1]])[first] if len(starts) else np.zeros(len(first), int)
    found, owner = [], []
    for n in SIZES:
        count = len(data) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n, np.uint64)
        inner = np.zeros(count, bool)
        for k in range(n):
            h = h * np.uint64(257) + data[k:k + count]
            if 0 < k < n - 1:
                inner |= space[k:k + count]
        at = np.flatnonzero(~inner & ~(space[:count] & space[n - 1:]))
        text = np.searchsorted(begin, at, "right") - 1
        # the last space of a text is shared with the next text's first: both keep their own n-grams
        found.append((mixed(h[at]) % np.uint64(buckets)).astype(np.int64))
        owner.append(np.minimum(text, len(texts) - 1))
    found = np.concatenate(found) if found else np.zeros(0, np.int64)
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    return found, owner


class Model:
    def __init__(self, languages, table, temperature, confidence):
        self.languages, self.table = languages, table
        self.temperature, self.confidence = temperature, confidence

    def logits(self, texts):
        found, owner = subwords(texts)
        n = len(texts)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        return np.stack([np.bincount(owner, self.table[found, k], minlength=n) / total
                         for k in range(len(self.languages))], axis=1)

    def probabilities(self, texts):
        return softmax(self.logits(texts) / self.temperature)


def softmax(z):
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows, languages, dim=DIM, epochs=EPOCHS, rate=0.5, seed=5, buckets=BUCKETS):
    """Model from (buckets, counts, language index) rows."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = max(1, len(rows) // 5)
    tune, learn = order[:held], order[held:] if len(rows) > 1 else order
    table = rng.normal(0, 0.1, (buckets, dim))
    out = np.zeros((dim, len(languages)))
    bias = np.zeros(len(languages))
    step, steps = 0, max(1, epochs * len(learn))
    for _ in range(epochs):
        for i in rng.permutation(learn):
            at, share, y = rows[i]
            hidden = share @ table[at]
            p = softmax((hidden @ out + bias)[None])[0]
            p[y] -= 1
            lr = rate * (1 - step / steps)
            step += 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * p
            table[at] -= (lr * len(at) ** 0.5) * share[:, None] * back[None]
    flat = table @ out + bias
    z = np.stack([rows[i][1] @ flat[rows[i][0]] for i in tune])
    y = np.array([rows[i][2] for i in tune])
    grid = np.geomspace(0.005, 20, 80)
    loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    best = float(grid[int(np.argmin(loss))])
    p = softmax(z / best)
    return Model(languages, flat, best, rejection(p.max(1), p.argmax(1) == y))


def rejection(confidence, right, wanted=WANTED):
    """Lowest confidence from which on the wanted share of answers is right; 1 if there is none."""
    order = np.argsort(-confidence, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= wanted)
    return float(confidence[order[good[-1]]]) if len(good) else 1.0


def fit(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", per_language=PER_LANGUAGE,
        sample_rows=SAMPLE_ROWS):
    """Model learnt from rows that are not held out; None without such rows.

    Rows are drawn by a hash of id and text and taken in its order, so a fit can be repeated.
    """
    known = docs.where(~is_held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.lit("sample"), F.col(doc_id), F.col(text)), F.lit(1 << 30)).alias("draw"))
    counts = [tuple(r) for r in known.groupBy("lang").count().collect()]  # the classes of the model
    names = sorted(name for name, _ in counts)
    if not names:
        return None
    each = min(per_language, max(LEAST, sample_rows // len(names)))
    # broadcast as the model is: one row per class
    sizes = docs.sparkSession.createDataFrame(counts, "lang string, count long")
    sample = known.join(F.broadcast(sizes), "lang").where(
        F.col("draw") < F.lit(float(1 << 30)) * each / F.col("count")).select("lang", "text", "draw")

    def featured(batches):
        for batch in slices(batches):
            found, owner = subwords(texts_of(batch.column(1)))
            pairs, count = np.unique(owner * BUCKETS + found, return_counts=True)
            row, at = pairs // BUCKETS, pairs % BUCKETS
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(at.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))), batch.column(2)],
                names=["lang", "at", "count", "draw"])

    got = sample.mapInArrow(
        featured, "lang string, at array<int>, count array<int>, draw long").toArrow()
    got = got.sort_by([("draw", "ascending"), ("lang", "ascending")])
    number, rows = {name: k for k, name in enumerate(names)}, []
    for name, at, count in zip(got.column(0).to_pylist(), got.column(1), got.column(2)):
        count = count.values.to_numpy().astype(float)
        if len(count):
            rows.append((at.values.to_numpy(), count / count.sum(), number[name]))
    return train(rows, names) if rows else None


def predict(docs: DataFrame, model, text="text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``accepted`` to the rows."""
    schema = with_fields(docs.schema, lang_pred=T.StringType(), score=T.DoubleType(),
                         accepted=T.BooleanType())

    def run(batches):
        for batch in slices(batches, text):
            column = batch.column(batch.schema.get_field_index(text))
            lettered = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_numpy(
                zero_copy_only=False)
            if model is None:
                names, score = np.full(batch.num_rows, NONE, object), np.zeros(batch.num_rows)
                sure = np.zeros(batch.num_rows, bool)
            else:
                p = model.probabilities(texts_of(column))
                names = np.array(model.languages, object)[p.argmax(1)]
                names[~lettered] = NONE
                score = np.where(lettered, p.max(1), 0.0)
                sure = lettered & (score >= model.confidence)
            yield appended(batch, {"lang_pred": pa.array(names, pa.string()),
                                   "score": pa.array(score), "accepted": pa.array(sure)})

    return docs.mapInArrow(run, schema)
