import glob
import os
import time

import numpy as np
import pytest

from delaylens.llm import rules, simhash, substrings
from delaylens.session import FREE_SHUFFLES, stored
from tests.llm.helpers import (
    SCHEMA, documents, fingerprint, groups, kept_words, rule_counts, sha,
)

LABELS = "doc_id long, quality int, toxic int"


def key(i):
    return (1 << 63) - 1 if i is None else i


def test_rule_counts(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "N_WORDS")
    got = rules.statistics(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in [*rules.COUNTS, "base_failed"]) == rule_counts(r.text)


def test_forest_isolates_unusual_rows():
    rng = np.random.default_rng(0)
    usual = rng.normal(0, 0.02, (2000, 3)) + 0.5
    odd = np.array([[0.0, 1.0, 0.5], [1.0, 0.0, 0.0]])
    forest = rules.Forest(np.concatenate([usual, odd]))
    assert forest.score(odd).min() > np.quantile(forest.score(usual), 0.999)
    assert rules.Forest(np.zeros((0, 3))).score(odd).tolist() == [0, 0]


def test_threshold_weighs_good_rows():
    bins = [(100, True, 990), (150, True, 10), (140, False, 10), (160, False, 90)]
    assert 0.075 < rules.threshold(bins, 100.0) <= 0.08
    assert 0.05 < rules.threshold(bins, 1.0) <= 0.07
    assert rules.threshold([], 1.0) == np.inf


def test_rules_end_to_end(spark):
    rows = documents()
    noise = [(1000 + k, " ".join(f"w{k}x{j}###$$$" for j in range(80)), "en", "s", 0) for k in range(8)]
    df = spark.createDataFrame(rows + noise, SCHEMA)
    labels = spark.createDataFrame(
        [(i, 0 if i >= 1000 else 1, 0) for i, *_ in rows + noise if i is not None] + [(None, 1, 0)], LABELS)
    got = {r.doc_id: r for r in rules.apply(df, labels).collect()}
    assert not any(got[1000 + k].kept for k in range(8))
    good = [i for i, t, *_ in rows if i is not None and i >= 200]
    assert all(got[i].kept for i in good)
    assert not got[3].kept and not got[14].kept
    stored = {r.doc_id: r.kept for r in rules.apply_stored(df, labels).collect()}
    assert stored == {i: r.kept for i, r in got.items()}
    # no labels, no documents
    free = rules.apply(df, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in free)
    assert rules.apply(df.limit(0), labels).count() == 0


def test_fingerprints_and_groups(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "source")
    prints = [fingerprint(t) for _, t, *_ in rows]
    roots = groups(prints)
    smallest = {}
    for (i, *_), r in zip(rows, roots):
        smallest[r] = min(smallest.get(r, key(None)), key(i))
    want = sorted((key(i), f"{p:016x}", smallest[r]) for (i, *_), p, r in zip(rows, prints, roots))
    for sizes in ({}, {"shard_rows": 8, "sample_rows": 30}, {"dense_rows": 0}):
        got = simhash.components(simhash.fingerprints(df), **sizes).collect()
        assert sorted((key(r.doc_id), f"{r.fp % (1 << 64):016x}", r.component_id) for r in got) == want
    kept = simhash.keep_one(df.withColumnRenamed("source", "rid"))
    assert kept.columns == ["doc_id", "text", "rid"] and kept.count() == len(set(roots))
    assert simhash.components(simhash.fingerprints(df.limit(0))).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_shard_search_finds_all_pairs(bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2 ** 63, 900).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 20, (900, 4)).astype(np.uint64)
    points = np.unique(np.concatenate([base, base[:1] ^ np.bitwise_xor.reduce(flips, axis=1)]))
    want = simhash.Union(len(points))
    want.link(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None]) <= bits))
    want.flatten()
    a, b = simhash.shard_links(points, bits)
    found = dict(zip(a.tolist(), b.tolist()))
    assert all(found.get(int(p), int(p)) == int(points[r]) for p, r in zip(points, want.up))
    nodes = simhash.grow(points[::2], len(points), bits, 100)
    rows, leaves = simhash.route(nodes, points, bits)
    shards = {}
    for r, leaf in zip(rows.tolist(), leaves.tolist()):
        shards.setdefault(r, set()).add(leaf)
    for i, j in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None]) <= bits)):
        assert shards[int(i)] & shards[int(j)]


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 3}, {"bucket_rows": 2, "hot_rows": 1}])
def test_substring_removal(spark, sizes):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted((key(i), len(w), len(w) - len(k), sha(" ".join(k))) for (i, *_), (w, k) in zip(
        rows, kept_words([r[:2] for r in rows])))
    got = substrings.digests(df, **sizes).collect()
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert any(r.n_removed for r in got)


def test_substring_rows(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "gone")
    got = substrings.remove_repeats(df).collect()
    want = kept_words([r[:2] for r in rows])
    texts = sorted((key(i), (t or "") if len(w) == len(k) else " ".join(k))
                   for (i, t, *_), (w, k) in zip(rows, want))
    assert sorted((key(r.doc_id), r.text or "") for r in got) == texts
    assert substrings.digests(df.limit(0)).count() == 0
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def shuffled_bytes(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = [f for d in disk.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")]
    return {f: os.path.getsize(f) for f in files}


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 2}])
def test_substring_steps_leave_no_shuffle_files(spark, sizes):
    df = spark.createDataFrame(documents(), SCHEMA).repartition(4)
    earlier = set(shuffled_bytes(spark))
    out = substrings.remove_repeats(df, **sizes)
    for _ in range(50):
        left = sum(n for f, n in shuffled_bytes(spark).items() if f not in earlier)
        if left < 2000:
            break
        time.sleep(0.1)
    assert left < 2000
    assert out.where("n_removed > 0").count()


@pytest.mark.parametrize("own", [None, "false", "true"])
def test_stored_leaves_the_session_as_it_was(spark, own):
    try:
        if own:
            spark.conf.set(FREE_SHUFFLES, own)
        before = spark.conf.get(FREE_SHUFFLES, None)
        frame = spark.range(50).repartition(3, "id")
        assert stored(frame, "freed", free=True).count() == frame.count() == 50
        assert stored(frame, "freed", free=True).count() == 50
        assert spark.conf.get(FREE_SHUFFLES, None) == before
        with pytest.raises(Exception):
            stored(frame.selectExpr("raise_error('x') AS a"), "failed", free=True)
        assert spark.conf.get(FREE_SHUFFLES, None) == before
    finally:
        spark.conf.unset(FREE_SHUFFLES)
