"""Backoff scores, source divergence and centroid clustering against their definitions."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from delaylens.llm import backoff, centroids, divergence
from delaylens.llm.common import id_remainder
from tests.llm.helpers import SCHEMA, WORD, documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").encode().lower().decode()


def lm_scores(rows, weight):
    """(id, n_tokens, n_known, N, base, score) by counting in dictionaries."""
    split = [(i, WORD.findall(lowered(t)) + [""], zlib.crc32(str("" if i is None else i).encode()) % 7
              != 2) for i, t in rows]
    uni, pair, history = (collections.Counter() for _ in range(3))
    for _, ws, learnt in split:
        if learnt:
            uni.update(ws)
            pair.update(zip([None] + ws[:-1], ws))
            history.update([None] + ws[:-1])
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, ws, learnt in split:
        p = [(uni[w] + 1) / (n + v + 1) for w in ws]
        smooth = [(pair[h, w] + weight * q) / (history[h] + weight)
                  for h, w, q in zip([None] + ws[:-1], ws, p)]
        out.append((i, learnt, len(ws), sum(uni[w] > 0 for w in ws), n,
                    round(sum(map(math.log10, p)), 7), round(sum(map(math.log10, smooth)), 7)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes, bucket_tokens", [(1 << 22, 1 << 20), (2000, 150)])
def test_language_model_scores(spark, block_bytes, bucket_tokens):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("score", F.lit("mine"))
    got = backoff.score(df, id_remainder("doc_id", 7) != 2, weight=20.0, block_bytes=block_bytes,
                        bucket_tokens=bucket_tokens).collect()
    got = sorted(((*r[:5], round(r[5], 7), round(r[6], 7)) for r in got), key=repr)
    assert got == lm_scores([r[:2] for r in rows], 20.0)


def test_language_model_without_training_or_rows(spark):
    rows = [(1, "a b"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = backoff.score(df, F.lit(False)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                  for r in got) == [(1, 3, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0)]
    assert backoff.score(df.limit(0), F.lit(True)).count() == 0


def test_probabilities_of_a_state_sum_to_one():
    import numpy as np
    counts, keys = np.array([3, 2, 0, 2]), np.array([1, 4, 5, 7, 12, 13])
    machine = backoff.Automaton(counts, keys, np.array([3, 1, 0, 1, 1, 1]), 2, 7, 3, 5.0)
    for state in (machine.START, 2, 3):
        p = 10.0 ** machine.step(np.full(4, state), np.arange(4))
        # no word is unknown to the model but the third, which holds the place of all unknown ones
        history = {1: 2, 2: 3, 3: 2}[state]
        arcs = {1: [1, 1, 0, 0], 2: [0, 3, 0, 0], 3: [1, 0, 0, 1]}[state]
        want = [(c + 5.0 * (n + 1) / 11) / (history + 5.0) for c, n in zip(arcs, counts)]
        assert np.allclose(p, want) and abs(sum(want) - (sum(arcs) + 5) / (history + 5)) < 1e-12


def audit_rows(rows, min_docs=10, top=10):
    docs = [(t or "", lang or "", source or "") for t, lang, source in rows]
    occ, df = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for t, lang, source in docs:
        found = [x.lower() if x.isascii() else lowered(x) for x in TERM.findall(t)]
        occ[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang in {d[1] for d in docs}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        groups = sorted({s for _, x, s in docs if x == lang})

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(occ[lang, s]) for s in groups}
        q = shares(sum((occ[lang, s] for s in groups), collections.Counter()))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept
                     if occ[lang, s][t] and p[s][t] > q[t]]
            for part, found, n in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item.decode(), -v, k + 1)
                        for k, (v, item) in enumerate(sorted(found)[:n])]
    return sorted(out)


def audit_table(seed=3):
    rng = random.Random(seed)
    words = ["Ab", "été", "x" * 50, "ÄÖ", *("w" + chr(97 + k) for k in range(26))]
    rows = []
    for k in range(160):
        source = rng.choice(["hot", "hot", "s1", "s2", None, "é"])
        n = rng.choice([0, 3, 30])
        rows.append((" 1,".join(rng.choices(words, range(1, len(words) + 1), k=n)),
                     rng.choice(["en", "en", None]), source))
    rows += [(None, "en", "empty"), ("rare words only", "xx", "a"), ("", "xx", "b"), ("", None, None)]
    return rows + rows[:20]


@pytest.mark.parametrize("entries", [2_000_000, 20])
def test_source_divergence(spark, monkeypatch, entries):
    monkeypatch.setattr(divergence, "MATRIX_ENTRIES", entries)
    monkeypatch.setattr(divergence, "COUNT_BYTES", 500 if entries == 20 else 8_000_000)
    rows = audit_table()
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    got = sorted(map(tuple, divergence.audit(df.withColumn("term", F.lit(1)).withColumn(
        "n", F.lit(2))).collect()))
    assert got == audit_rows(rows)
    assert divergence.audit(df.limit(0)).count() == 0


def test_leading_terms_with_ties(spark):
    rows = [(" ".join(f"t{chr(97 + k)}" for k in range(25)), "en", "a")] * 12 + [
        ("other words", "en", "b")] * 12
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(df).collect())) == audit_rows(rows)


def kmeans(rows, clusters, rounds):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(v is not None and math.isfinite(v) for v in e):
            kept.append((i, [math.floor(64 * v) for v in e]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(
        f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres))
                for _, x in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centres)):
            own = [x for (_, x), (_, at) in zip(kept, found) if at == k]
            if own:
                centres[k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    per = collections.Counter()
    for d, k in found:
        per[k] += d
    return sorted(((i, k, d, per[k], sum(per.values()), centres[k])
                   for (i, _), (d, k) in zip(kept, found)), key=repr)


def vectors(seed=5, n=300):
    rng = random.Random(seed)
    middle = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(k, [round(c + rng.gauss(0, 0.2), 1) for c in rng.choice(middle)]) for k in range(n)]
    same = [0.5] * 64
    rows += [(1000 + k, same) for k in range(60)] + [(7, same), (7, same), (None, same)]
    return rows + [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 63 + [None]),
                   (2004, [1.0] * 63 + [math.inf]), (2005, [math.nan] + [1.0] * 63)]


VECTORS = "vec_id long, embedding array<double>"


@pytest.mark.parametrize("clusters, rounds", [(16, 3), (3, 6), (1, 1), (500, 2)])
def test_centroid_clustering(spark, clusters, rounds):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(3).withColumn("cluster", F.lit("mine"))
    got = centroids.cluster(df, clusters=clusters, rounds=rounds).collect()
    assert sorted(map(tuple, got), key=repr) == kmeans(rows, clusters, rounds)


def test_bounds_skip_distances(spark, monkeypatch):
    """Later rounds compute fewer distances than all, and none wrongly."""
    import numpy as np
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-9, 9, (200, 64)) + 300 * k for k in range(4)])
    history = centroids.History(x[[0, 200, 400, 600]])
    found = history.begin(x)
    asked = []
    real = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda a, c: asked.append(len(a)) or real(a, c))
    for _ in range(4):
        history.rounds.append(np.stack([x[found[0] == k].sum(0) // max(1, (found[0] == k).sum())
                                        for k in range(4)]))
        found = history.assign(x, found[0], found[2], found[3])
        full = np.stack([real(x, c) for c in history.rounds[-1]], 1)
        assert (found[0] == full.argmin(1)).all() and (found[1] == full.min(1)).all()
    assert sum(asked) == 4 * len(x)  # only the own centroid of each vector


def test_clustering_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], VECTORS)
    got = centroids.cluster(df)
    assert got.count() == 0 and got.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert centroids.cluster(df.limit(0)).count() == 0
