"""Histogram boosting against a plain-Python first tree, and its promises."""

import math
import random

import pytest

from delaylens.operators import boosting
from delaylens.session import scratch

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for _ in range(600):
        a, b, c = rng.gauss(0, 1), float(rng.randint(0, 4)), rng.random()
        late = float(a + 0.5 * b + rng.gauss(0, 0.5) > 1)
        out.append((a, b if rng.random() < 0.95 else None, c, late, 10 * a * (b > 2) + rng.random()))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c double, late double, m double").repartition(3)


def grown(rows, target, loss, depth, rate, min_leaf):
    """The first tree by trying every cut between distinct values, as {row: score}."""
    base = sum(r[target] for r in rows) / len(rows)
    base = math.log(base / (1 - base)) if loss == "logistic" else base
    p = 1 / (1 + math.exp(-base)) if loss == "logistic" else None
    slope = lambda r: p - r[target] if p else base - r[target]
    bend = lambda r: p * (1 - p) if p else 1.0
    value = lambda r, f: math.inf if r[f] is None else r[f]

    def worth(part):
        return sum(map(slope, part)) ** 2 / sum(map(bend, part))

    scores = {}

    def leaf(part):
        for r in part:
            scores[id(r)] = base - rate * sum(map(slope, part)) / sum(map(bend, part))

    def split(part, level):
        best = (1e-9, None)
        if level < depth and len(part) >= 2 * min_leaf:
            for f in range(3):
                for at in sorted({value(r, f) for r in part})[:-1]:
                    left = [r for r in part if value(r, f) <= at]
                    right = [r for r in part if value(r, f) > at]
                    if min(len(left), len(right)) >= min_leaf:
                        gain = worth(left) + worth(right) - worth(part)
                        if gain > best[0] + 1e-9:
                            best = (gain, left, right)
        if best[1] is None:
            return leaf(part)
        split(best[1], level + 1)
        split(best[2], level + 1)

    split(rows, 0)
    return [scores[id(r)] for r in rows]


@pytest.mark.parametrize("loss, target", [("logistic", 3), ("squared", 4)])
def test_first_tree_by_brute_force(spark, loss, target):
    rng = random.Random(4)
    # few values per feature, so that every value is a code of its own
    rows = [(float(rng.randint(0, 20)), rng.choice([None, 1.0, 2.0, 3.0]), float(rng.randint(0, 9)))
            for _ in range(300)]
    rows = [(*r, float(r[0] + 3 * (r[1] or 5) + rng.gauss(0, 6) > 16), r[0] * 3 + rng.random())
            for r in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, late double, m double")
    model = boosting.fit(df, FEATURES, df.columns[target], loss, rounds=1, depth=3, min_leaf=10,
                         held_share=0.0)
    codes = model.codes([[math.nan if r[f] is None else r[f] for r in rows] for f in range(3)])
    want = grown(rows, target, loss, 3, 0.1, 10)
    assert len(model.trees) == 1 and max(
        abs(x - y) for x, y in zip(model.margin(codes), want)) < 1e-5


@pytest.mark.parametrize("loss, target", [("logistic", "late"), ("squared", "m")])
def test_loss_falls_every_round(spark, frame, loss, target):
    model = boosting.fit(frame, FEATURES, target, loss, rounds=14, depth=3, min_leaf=5, held_share=0.0)
    learnt = [x[0] for x in model.losses]
    assert len(model.trees) == 14 and len(learnt) == 15  # stored once in between
    assert all(later < earlier for earlier, later in zip(learnt, learnt[1:]))
    alone = boosting.fit(frame.coalesce(1), FEATURES, target, loss, rounds=14, depth=3, min_leaf=5,
                         held_share=0.0)  # one page, so one task grows the same trees
    assert [(t.feature, t.cut) for t in alone.trees] == [(t.feature, t.cut) for t in model.trees]
    shares = model.importance()
    assert abs(shares.sum() - 1) < 1e-9 and shares.argmax() == 0


def test_it_stops_where_nothing_is_to_be_learnt(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.random(), rng.random(), rng.random(), float(rng.random() < 0.3))
                                for _ in range(400)], "a double, b double, c double, late double")
    model = boosting.fit(df, FEATURES, "late", rounds=100, depth=3, held_share=0.3, patience=3)
    assert len(model.trees) < 20 and len(model.losses) == len(model.trees) + 4


def test_models_are_saved_and_predict_the_same(spark, frame):
    model = boosting.fit(frame, FEATURES, "late", rounds=3, depth=2)
    path = scratch(spark, "boosted")
    model.save(spark, path)
    loaded = boosting.Boosted.load(spark, path)
    assert loaded == model
    both = loaded.predict(model.predict(frame, "p"), "q")
    assert both.where("p <> q OR p <= 0 OR p >= 1 OR p IS NULL").count() == 0
    prior = frame.selectExpr("avg(late)").first()[0]
    late, fine = (both.where(f"late = {k}").selectExpr("avg(p)").first()[0] for k in (1, 0))
    assert fine < prior < late


def test_nothing_to_learn_from(spark, frame):
    empty = boosting.fit(frame.limit(0), FEATURES, "late", rounds=5)
    assert empty.trees == [] and empty.predict(frame, "p").where("p > 0.5").count() == 0
    same = boosting.fit(frame.selectExpr("1.0D a", "1.0D b", "CAST(NULL AS DOUBLE) c", "late"),
                        FEATURES, "late", rounds=3)
    assert all(t.feature == [-1] for t in same.trees)
