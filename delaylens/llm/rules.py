"""Quality rules: statistics of each text, fixed limits, and an isolation forest on the rest.

``statistics`` adds the rule statistics of whole texts. ``Forest`` isolates rows by random splits;
rows that few splits isolate are unusual. ``fit`` grows it on a bounded sample of documents and
sets the threshold on all labelled rows: the cut with the lowest cost, where a lost share of the rows
labelled good weighs ``good_weight`` times a kept share of the others. ``apply`` adds the verdict.

Null texts have no words, so they fail the length rule. Rows with a missing or repeated id are
judged like any other; labels with a missing id are not used, several for one id are averaged.
Without documents or labels there is no forest and only the fixed limits count.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.llm.common import appended, stored, with_fields
from delaylens.llm.kernels import (
    exact_groups, mixed, per_text, range_hashes, same_ranges, sequence_hashes, slices, texts_of,
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: Rows that the forest is grown on, rows of one tree, trees, bins of the calibration.
SAMPLE_ROWS = 4096
TREE_ROWS = 256
TREES = 100
BINS = 2000
GOOD_WEIGHT = 10.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the forest sees, each independent of the length of the text.
#: Repeats count from a tolerated share on, as headers and footers repeat in good short texts.
FEATURES = ["mean_word", "symbol_share", "duplicate_line_excess", "repeat_excess", "upper_share",
            "mark_share"]
TOLERATED_LINES, TOLERATED_WORDS = 0.4, 0.3

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LETTER = _IS_UPPER.copy()
_IS_LETTER[97:123] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[33:127] = True
_IS_MARK &= ~_IS_LETTER
_IS_MARK[48:58] = False


def _between(mask, bounds):
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])


def _repeats(text_of, hashes, same, content):
    """For each value, whether it occurs again, and whether it occurred before, in its text."""
    key = mixed(hashes ^ (text_of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    group = exact_groups(key, lambda a, b: (text_of[a] == text_of[b]) & same(a, b),
                         lambda i: (text_of[i], content(i)))
    order = np.argsort(group, kind="stable")
    alike = group[order[1:]] == group[order[:-1]]
    again, before = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[:-1][alike]] = True
    before[order[1:][alike]] = True
    return again, before


def measured(texts):
    """Counts (int64) and features (float64) of each text."""
    data, offsets = texts.data, texts.offsets
    starts, ends, first = texts.words()
    n = len(texts)
    n_words = np.diff(first)
    visible = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lengths = visible[ends] - visible[starts]
    word_chars = per_text(first, lengths)
    n_symbols = _between(_IS_SYMBOL[data], offsets)

    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_text = np.searchsorted(offsets, line_start, "right") - 1
    next_break = np.append(breaks, len(data))[np.searchsorted(breaks, line_start)]
    line_end = np.minimum(next_break, offsets[line_text + 1])
    full = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_text = line_start[full], line_end[full], line_text[full]
    _, earlier = _repeats(
        line_text, range_hashes(data, line_start, line_end),
        lambda a, b: same_ranges(data, line_start, line_end, a, b),
        lambda i: data[line_start[i]:line_end[i]].tobytes())
    n_dup = np.bincount(line_text, earlier, minlength=n).astype(np.int64)
    n_lines = np.bincount(line_text, minlength=n)

    text_of = np.repeat(np.arange(n), n_words)
    three = sequence_hashes(range_hashes(data, starts, ends), 3)
    own = np.flatnonzero(text_of[:len(three)] == text_of[2:]) if len(three) else np.zeros(0, int)
    again, before = _repeats(
        text_of[own], three[own],
        lambda a, b: np.all([same_ranges(data, starts, ends, own[a] + k, own[b] + k)
                             for k in range(3)], axis=0),
        lambda i: tuple(data[starts[own[i] + k]:ends[own[i] + k]].tobytes() for k in range(3)))
    hit = np.zeros(len(starts), bool)
    found = own[again | before]
    for shift in range(3):
        hit[found + shift] = True
    n_repeat = per_text(first, hit.astype(np.int64))

    letters = np.maximum(_between(_IS_LETTER[data], offsets), 1)
    chars = np.maximum(word_chars, 1)
    words = np.maximum(n_words, 1)
    features = np.stack([
        word_chars / words, n_symbols / words,
        np.maximum(n_dup / np.maximum(n_lines, 1) - TOLERATED_LINES, 0),
        np.maximum(n_repeat / words - TOLERATED_WORDS, 0), _between(_IS_UPPER[data], offsets) / letters,
        _between(_IS_MARK[data], offsets) / chars], axis=1)
    return dict(zip(COUNTS, (n_words, word_chars, n_symbols, n_dup, n_repeat))), features


def failed_limits(counts):
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def statistics(docs: DataFrame, text="text", keep_text=True) -> DataFrame:
    """Add the counts, ``base_failed`` and ``features``; columns of these names are replaced."""
    extra = {c: T.LongType() for c in COUNTS} | {
        "base_failed": T.BooleanType(), "features": T.ArrayType(T.DoubleType())}
    base = docs.schema if keep_text else T.StructType(
        [f for f in docs.schema.fields if f.name != text])

    def run(batches):
        for batch in slices(batches, text):
            at = batch.schema.get_field_index(text)
            counts, features = measured(texts_of(batch.column(at)))
            cols = {c: pa.array(v) for c, v in counts.items()}
            cols["base_failed"] = pa.array(failed_limits(counts))
            cols["features"] = pa.ListArray.from_arrays(
                pa.array(np.arange(len(features) + 1, dtype=np.int32) * len(FEATURES)),
                pa.array(features.ravel()))
            own = batch if keep_text else batch.select(
                [i for i in range(batch.num_columns) if i != at])
            yield appended(own, cols)

    return docs.mapInArrow(run, with_fields(base, **extra))


class Forest:
    """Isolation forest: ``score`` is near 1 for rows that few random splits isolate."""

    def __init__(self, rows, trees=TREES, tree_rows=TREE_ROWS, seed=7):
        self.threshold = np.inf
        self.trees = []
        rng = np.random.default_rng(seed)
        size = min(tree_rows, len(rows))
        self.scale = self.path(size)
        limit = max(1, int(np.ceil(np.log2(max(2, size)))))
        for _ in range(trees if size > 1 else 0):
            self.trees.append(self._grown(rows[rng.choice(len(rows), size, False)], limit, rng))

    @staticmethod
    def path(n):
        """Mean path length of an unsuccessful search among ``n`` rows."""
        n = np.maximum(np.asarray(n, float), 1)
        deep = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n
        return np.where(n > 2, deep, np.where(n == 2, 1.0, 0.0))

    def _grown(self, rows, limit, rng):
        """Arrays (feature, cut, first child, path length); a leaf has feature -1."""
        nodes = [[-1, 0.0, 0, 0.0]]
        todo = [(0, rows, 0)]
        while todo:
            at, part, depth = todo.pop()
            low, high = part.min(0), part.max(0)
            wide = np.flatnonzero(high > low)
            if depth >= limit or len(part) < 2 or not len(wide):
                nodes[at][3] = depth + float(self.path(len(part)))
                continue
            f = int(rng.choice(wide))
            cut = rng.uniform(low[f], high[f])
            left = part[:, f] <= cut
            nodes[at][:3] = [f, cut, len(nodes)]
            todo += [(len(nodes), part[left], depth + 1), (len(nodes) + 1, part[~left], depth + 1)]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
        f, cut, child, length = zip(*nodes)
        return np.array(f), np.array(cut), np.array(child), np.array(length)

    def score(self, rows):
        if not self.trees or not len(rows):
            return np.zeros(len(rows))
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, child, length in self.trees:
            at = np.zeros(len(rows), int)
            live = every
            while len(live):
                f = feature[at[live]]
                live, f = live[f >= 0], f[f >= 0]
                here = at[live]
                at[live] = child[here] + (rows[live, f] > cut[here])
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / self.scale)

    def accepts(self, scores):
        return scores < self.threshold


def fit(measured_docs: DataFrame, labels: DataFrame, doc_id="doc_id", sample_rows=SAMPLE_ROWS,
        good_weight=GOOD_WEIGHT) -> Forest:
    """Forest and threshold from ``statistics`` of all documents and ``labels(doc_id, quality)``.

    The driver gets ``sample_rows`` feature rows and one count per score bin and label.
    """
    passed = measured_docs.where(~F.col("base_failed"))
    rank = F.xxhash64(F.col(doc_id), F.col("features"))
    sample = (passed.select("features").orderBy(rank).limit(sample_rows).toArrow()
              .column("features").combine_chunks())
    rows = sample.values.to_numpy().reshape(-1, len(FEATURES)) if len(sample) else np.zeros(
        (0, len(FEATURES)))
    forest = Forest(rows)
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).alias("good"))
    labelled = passed.select(F.col(doc_id).alias("doc_id"), "features").join(marks, "doc_id")

    def score(batches):
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(forest.score(values)), batch.column(1)], names=["score", "good"])

    bins = (labelled.select("features", "good").mapInArrow(score, "score double, good boolean")
            .groupBy(F.floor(F.col("score") * BINS).alias("bin"), "good").count().collect())
    forest.threshold = threshold([(r["bin"], r["good"], r["count"]) for r in bins], good_weight)
    return forest


def threshold(bins, good_weight, n_bins=BINS):
    """Cut of least cost from (bin, good, count); without labels of both kinds there is none."""
    counts = np.zeros((2, n_bins + 2))
    for at, is_good, count in bins:
        counts[int(is_good), int(at)] += count
    total = counts.sum(1, keepdims=True)
    if not total.all():
        return np.inf
    rejected = np.cumsum(counts[:, ::-1], 1)[:, ::-1] / total
    cost = good_weight * rejected[1] + 1 - rejected[0]
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    return float(best[len(best) // 2] / n_bins)


def judged(table: DataFrame, forest: Forest) -> DataFrame:
    """``statistics`` with ``anomaly`` and ``kept`` in place of ``features``."""
    score = forest.score

    @F.pandas_udf("double")
    def anomaly(features: pd.Series) -> pd.Series:
        return pd.Series(score(np.stack(features.to_list()).astype(float)) if len(features) else [])

    cut = float(forest.threshold)
    return table.withColumn("anomaly", anomaly("features")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(cut))).drop("features")


def apply(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """Documents with their counts, ``base_failed``, ``anomaly`` and ``kept``.

    Texts are measured once; they are stored with their statistics for the verdict.
    """
    table = stored(statistics(docs, text), "rules")
    return judged(table, fit(table, labels, doc_id))


def apply_stored(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """As ``apply``, without texts and other columns."""
    table = stored(statistics(docs.select(doc_id, text), text, keep_text=False), "rules")
    return judged(table, fit(table, labels, doc_id))
