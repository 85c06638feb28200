"""Gradient boosting on histograms: trees of one Spark aggregation per level.

Features are turned into at most 255 codes once, by quantile cuts, and packed with the target into pages of
some ten thousand rows. For every level of a tree one job runs over the pages: each task finds the node
of its rows in the tree so far, and adds up first and second derivatives of the loss per (node,
feature, code); Spark sums these over tasks, and the driver picks the best cut of each node from the sums,
whose number depends on depth, features and codes only. Leaf values follow from the same sums, so a
tree of depth d costs d jobs. Scores of the rows are stored again every few trees; in between, tasks
add the newer trees themselves. A table of one page (``PAGE_ROWS`` rows at most) gets all its trees by
the same sums and cuts in a single task, as every job would have one task anyway.

Derivatives are summed as integers (``SCALE`` to one), so trees do not depend on partitions or order.
A share of the rows, chosen by a hash of their values, is not learnt from: boosting stops when their
loss has not fallen for ``patience`` trees, and trees after the best are dropped.
"""

import json
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.session import stored

CODES = 255
PAGE_ROWS = 32_768
#: Integers to one unit of a derivative.
SCALE = {"logistic": float(1 << 30), "squared": float(1 << 20)}
STORE_EVERY = 10
PAGES = "codes binary, target binary, held binary, margin binary"
SUMS = "part int, feature int, code int, g long, h long, n long"
#: Parts of the sums that are no nodes: losses of rows learnt from and held back.
LEARNT, HELD = -1, -2


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1. Codes up to ``cut`` go left."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    child: list = field(default_factory=lambda: [0])  # the right one follows
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def split(self, node, feature, cut, gain):
        """Give a leaf two children; returns them."""
        at = len(self.feature)
        self.feature[node], self.cut[node], self.child[node], self.gain[node] = feature, cut, at, gain
        for values, new in ((self.feature, -1), (self.cut, 0), (self.child, 0), (self.value, 0.0),
                            (self.gain, 0.0)):
            values += [new, new]
        return at, at + 1

    def node_of(self, codes):
        """Leaf of every row of a matrix of codes."""
        feature, cut, child = (np.array(v) for v in (self.feature, self.cut, self.child))
        at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            here = at[rows]
            at[rows] = child[here] + (codes[rows, feature[here]] > cut[here])
        return at

    def score(self, codes):
        return np.array(self.value)[self.node_of(codes)]


@dataclass
class Boosted:
    """A fitted model: features with their cuts, the first score and the trees."""
    loss: str
    features: list
    cuts: list
    base: float
    trees: list
    losses: list = field(default_factory=list)  # (learnt, held back) before each tree and after all

    def codes(self, columns):
        """Codes of feature columns; missing values count as the largest."""
        out = np.empty((len(columns[0]), len(columns)), np.uint8)
        for k, (values, cuts) in enumerate(zip(columns, self.cuts)):
            x = np.asarray(values, float)
            out[:, k] = np.searchsorted(cuts, np.where(np.isnan(x), np.inf, x), "left")
        return out

    def margin(self, codes):
        return self.base + sum((t.score(codes) for t in self.trees), np.zeros(len(codes)))

    def predict(self, df: DataFrame, out) -> DataFrame:
        """Add the probability, or the expected value, as column ``out``."""
        model = self

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            m = model.margin(model.codes(columns))
            return pd.Series(1 / (1 + np.exp(-m)) if model.loss == "logistic" else m)

        return df.withColumn(out, score(*[F.col(f).cast("double") for f in self.features]))

    def importance(self):
        """Share of the total gain that each feature brought."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
        return total / total.sum() if total.sum() else total

    def parts(self):
        """The model as texts: what is common to all trees, and each tree."""
        head = {"loss": self.loss, "features": self.features, "cuts": self.cuts, "base": self.base,
                "losses": self.losses}
        return [json.dumps(x) for x in [head, *map(asdict, self.trees)]]

    @classmethod
    def of(cls, parts):
        head, *trees = map(json.loads, parts)
        return cls(trees=[Tree(**t) for t in trees], **head)

    def save(self, spark: SparkSession, path) -> None:
        spark.createDataFrame(list(enumerate(self.parts())), "position int, part string").coalesce(
            1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path):
        return cls.of([r["part"] for r in spark.read.parquet(path).orderBy("position").collect()])


def cut_points(df: DataFrame, features, codes=CODES) -> list:
    """Sorted distinct quantiles of each feature: the cuts between codes."""
    shares = [k / codes for k in range(1, codes)]
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 10 * codes).alias(f"c{k}")
                   for k, f in enumerate(features)]).first()
    return [sorted({float(v) for v in row[k] or [] if v == v}) for k in range(len(features))]


def _derivatives(loss, target, margin):
    if loss == "logistic":
        p = 1 / (1 + np.exp(-margin))
        return p - target, p * (1 - p), np.logaddexp(0, margin) - target * margin
    return margin - target, np.ones(len(target)), (margin - target) ** 2 / 2


def pages(df: DataFrame, target, model: Boosted, held_share, page_rows=PAGE_ROWS) -> DataFrame:
    """Codes, target and first score of all rows, packed and stored."""
    columns = [F.col(f).cast("double").alias(f"f{k}") for k, f in enumerate(model.features)]
    held = F.pmod(F.xxhash64(*columns, F.col(target).cast("double")), F.lit(1000)) < round(
        1000 * held_share)
    width = len(model.features)

    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= page_rows:
                yield page(pa.Table.from_batches(waiting))
                waiting, size = [], 0
        if size:
            yield page(pa.Table.from_batches(waiting))

    def page(table):
        codes = model.codes([table[k].to_numpy() for k in range(width)])
        y = table["target"].to_numpy().astype(float)
        parts = [codes, y, table["held"].to_numpy(), np.full(len(y), model.base)]
        return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts],
                                          names=["codes", "target", "held", "margin"])

    rows = df.select(*columns, F.col(target).cast("double").alias("target"), held.alias("held"))
    return stored(rows.mapInArrow(run, PAGES), "boosting-pages")


def _unpacked(batch, width, newer):
    for codes, y, held, margin in zip(*[batch.column(k).to_pylist() for k in range(4)]):
        codes = np.frombuffer(codes, np.uint8).reshape(-1, width)
        score = np.frombuffer(margin, float)
        for tree in newer:
            score = score + tree.score(codes)
        yield codes, np.frombuffer(y, float), np.frombuffer(held, bool), score


def rescored(table: DataFrame, newer, width) -> DataFrame:
    """The pages with the newer trees added to their scores, stored."""
    def run(batches):
        for batch in batches:
            scores = [score.tobytes() for *_, score in _unpacked(batch, width, newer)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(scores, pa.binary())],
                names=["codes", "target", "held", "margin"])

    return stored(table.mapInArrow(run, PAGES), "boosting-pages")


def sums_of(unpacked, loss, tree, nodes, width) -> np.ndarray:
    """Rows of ``SUMS`` for unpacked pages and the nodes of a tree."""
    place = np.full(len(tree.feature), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    scale, size = SCALE[loss], len(nodes) * (CODES + 1)
    total = np.zeros((3, width, size), np.int64)
    losses = np.zeros((2, 2), np.int64)
    for codes, y, held, score in unpacked:
        g, h, lost = _derivatives(loss, y, score)
        lost = np.rint(lost * scale / 1024).astype(np.int64)
        for k, rows in enumerate((~held, held)):
            losses[k] += [lost[rows].sum(), rows.sum()]
        at = place[tree.node_of(codes)]
        used = (at >= 0) & ~held
        at, codes = at[used] * (CODES + 1), codes[used]
        sums = [np.rint(v[used] * scale) for v in (g, h)]
        for f in range(width):
            key = at + codes[:, f]
            for k, v in enumerate(sums):
                # exact: partial sums of a page stay below 2**53
                total[k, f] += np.bincount(key, v, size).astype(np.int64)
            total[2, f] += np.bincount(key, minlength=size)
    f, key = np.nonzero(total[2])
    extra = [[LEARNT, 0, 0, losses[0, 0], 0, losses[0, 1]], [HELD, 0, 0, losses[1, 0], 0, losses[1, 1]]]
    own = np.stack([key // (CODES + 1), f, key % (CODES + 1), *total[:, f, key]], 1)
    return np.concatenate([own, np.array(extra, np.int64)])


class Pages:
    """The stored pages of a table, and the trees that their scores do not hold yet."""

    def __init__(self, table: DataFrame, loss, width):
        self.table, self.loss, self.width, self.newer = table, loss, width, []

    def sums(self, tree, nodes):
        """Totals for the nodes of a tree: one job; nodes x features x codes rows at most come back."""
        loss, width, newer = self.loss, self.width, self.newer

        def run(batches):
            found = sums_of((page for batch in batches for page in _unpacked(batch, width, newer)),
                            loss, tree, nodes, width)
            kinds = [pa.int32()] * 3 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, k], t) for k, t in enumerate(kinds)],
                names=["part", "feature", "code", "g", "h", "n"])

        found = self.table.mapInArrow(run, SUMS).groupBy("part", "feature", "code").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
        return np.stack([c.to_numpy() for c in found.columns], 1)

    def add(self, tree):
        self.newer.append(tree)
        if len(self.newer) == STORE_EVERY:
            self.table, self.newer = rescored(self.table, self.newer, self.width), []


class OnePage:
    """As ``Pages``, for rows that are here."""

    def __init__(self, unpacked, loss, width):
        self.pages, self.loss, self.width = unpacked, loss, width

    def sums(self, tree, nodes):
        return sums_of(self.pages, self.loss, tree, nodes, self.width)

    def add(self, tree):
        self.pages = [(codes, y, held, score + tree.score(codes))
                      for codes, y, held, score in self.pages]


def best_cuts(sums, n_nodes, width, scale, min_leaf, l2):
    """For each node (gain, feature, code, left sums, total sums); gain 0 if no cut helps."""
    grid = np.zeros((3, n_nodes, width, CODES + 1))
    own = sums[sums[:, 0] >= 0]
    grid[:, own[:, 0], own[:, 1], own[:, 2]] = own[:, 3:].T
    grid[:2] /= scale
    left = grid.cumsum(3)
    whole = left[:, :, :1, -1:]
    right = whole - left

    def worth(part):
        return np.divide(part[0] ** 2, part[1] + l2, out=np.zeros_like(part[0]),
                         where=part[1] + l2 > 1e-12)

    gain = worth(left) + worth(right) - worth(whole)
    gain[(left[2] < min_leaf) | (right[2] < min_leaf)] = 0
    flat = gain.reshape(n_nodes, -1)
    # equal gains: the first feature and code, whatever the last bits of the floats
    top = (flat >= flat.max(1, keepdims=True) * (1 - 1e-12)).argmax(1)
    out = []
    for node, at in enumerate(top):
        f, code = divmod(int(at), CODES + 1)
        out.append((float(flat[node, at]), f, code, left[:, node, f, code], whole[:, node, 0, 0]))
    return out


def grow(model: Boosted, rows, rounds, depth, rate, min_leaf, l2, patience) -> Boosted:
    """Add trees to a model from the sums that ``rows`` give."""
    width, scale, best = len(model.features), SCALE[model.loss], (np.inf, 0)

    def note(sums):
        """Losses per row after the trees so far; whether it is time to stop."""
        nonlocal best
        lost = {int(r[0]): (float(r[3]) * 1024 / scale, int(r[5])) for r in sums if r[0] < 0}
        (learnt, n), (held, n_held) = (lost.get(k, (0.0, 0)) for k in (LEARNT, HELD))
        model.losses.append([learnt / max(1, n), held / max(1, n_held)])
        if not n_held or model.losses[-1][1] < best[0] - 1e-9:
            best = (model.losses[-1][1], len(model.trees))
        return len(model.trees) - best[1] >= patience

    stop = False
    while not stop and len(model.trees) < rounds:
        tree, nodes = Tree(), [0]
        for level in range(depth):
            sums = rows.sums(tree, nodes)
            if level == 0 and (stop := note(sums)):
                break
            following = []
            for node, (gain, f, code, left, whole) in zip(nodes, best_cuts(
                    sums, len(nodes), width, scale, min_leaf, l2)):
                if gain <= 1e-9:
                    continue
                for child, part in zip(tree.split(node, f, code, gain), (left, whole - left)):
                    tree.value[child] = float(-rate * part[0] / max(part[1] + l2, 1e-12))
                    if part[2] >= 2 * min_leaf:
                        following.append(child)
            nodes = following
            if not nodes:
                break
        if stop or tree.feature == [-1]:  # no cut helps, and none will
            stop = True
        else:
            model.trees.append(tree)
            rows.add(tree)
    if not stop and rounds:
        note(rows.sums(Tree(), []))
    model.trees = model.trees[:best[1]]
    return model


def fit(df: DataFrame, features, target, loss="logistic", rounds=200, depth=5, rate=0.1, min_leaf=1,
        l2=0.0, held_share=0.1, patience=10, codes=CODES, page_rows=PAGE_ROWS) -> Boosted:
    """Boost trees on the rows of ``df``; ``loss`` is logistic (target 0 or 1) or squared."""
    features = list(features)
    mean = df.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0
    share = min(max(mean, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share))) if loss == "logistic" else float(mean)
    model = Boosted(loss, features, cut_points(df, features, codes), base, [])
    table, width = pages(df, target, model, held_share, page_rows), len(features)
    sizes = rounds, depth, rate, min_leaf, l2, patience
    if table.limit(2).count() > 1:
        return grow(model, Pages(table, loss, width), *sizes)

    def run(batches):
        here = [page for batch in batches for page in _unpacked(batch, width, [])]
        if here:
            parts = grow(model, OnePage(here, loss, width), *sizes).parts()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts)],
                                             names=["position", "part"])

    parts = table.mapInArrow(run, "position int, part string").orderBy("position").collect()
    return Boosted.of([r["part"] for r in parts]) if parts else model
