"""Bucketed history: several snapshots against a plain-Python definition, and its plans."""

import os
import random

import pytest

from delaylens.session import scratch
from delaylens.sources.history import BucketedHistory

SCHEMA = "id string, a double, b double, note string"
TIMES = ["2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 12:30:00", "2024-05-01 00:00:00"]


def extracts(seed):
    """Rows change, come late, come twice, come without a key, stay away."""
    rng = random.Random(seed)
    rows = []
    for k in range(4):
        part = [(f"k{i}", rng.choice([1.0, 2.0, None]), float(i % 3), f"note{k}")
                for i in range(60) if rng.random() < 0.7]
        part += part[:5] + [(i, 9.0, b, n) for i, _, b, n in part[5:8]] + [(None, 1.0, 1.0, "x")]
        rows.append(part)
    return rows


def defined(parts):
    """(row, from, to) of every version."""
    first = lambda r: tuple((v is not None, v) for v in (r[1], r[2], r[0], r[3]))
    heads, out = {}, []
    for at, rows in zip(TIMES, parts):
        out += [[r, at, None] for r in rows if r[0] is None]
        for key in {r[0] for r in rows} - {None}:
            row = min((r for r in rows if r[0] == key), key=first)
            old = heads.get(key)
            if old is None or old[0][1:3] != row[1:3]:
                if old is not None:
                    old[2] = at
                heads[key] = [row, at, None]
                out.append(heads[key])
    return sorted(((*r, a, b, b is None) for r, a, b in out), key=repr)


def found(store):
    return sorted(((*r[:4], str(r[4]), str(r[5]) if r[5] else None, r[6])
                   for r in store.history().collect()), key=repr)


def files(path, table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(f"{path}/{table}") for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_in_a_row(spark, seed):
    parts, path = extracts(seed), scratch(spark, "history")
    frames = [spark.createDataFrame(p, SCHEMA) for p in parts]
    store = BucketedHistory(spark, path, frames[0].schema, "id", ["a", "b"], buckets=3)
    seen = {}
    for k, (df, at) in enumerate(zip(frames, TIMES)):
        store.snapshot(df, at)
        assert found(store) == defined(parts[:k + 1])
        now = files(path, "versions") | files(path, "closings")
        assert seen.items() <= now.items()  # nothing older was written again
        seen = now
    store.snapshot(frames[0], TIMES[-1])  # done already
    assert found(store) == defined(parts)
    with pytest.raises(ValueError, match="later snapshot"):
        store.snapshot(frames[0], TIMES[0][:-1] + "1")
    # another session finds the same tables in the folder
    for name in store.names.values():
        spark.sql(f"DROP TABLE {name}")
    again = BucketedHistory(spark, path, frames[0].schema, "id", ["a", "b"], buckets=3)
    assert found(again) == defined(parts)


def test_history_is_not_shuffled(spark):
    path = scratch(spark, "history")
    df = spark.createDataFrame(extracts(3)[0], SCHEMA)
    store = BucketedHistory(spark, path, df.schema, "id", ["a", "b"], buckets=3)
    store.snapshot(df, TIMES[0])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [x._jdf.queryExecution().executedPlan().toString()
                 for x in (store.history(), store.changes(df))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plans[0] and plans[0].count("Exchange") == 0
    assert plans[1].count("Exchange") == 1 and "heads" in plans[1]


def test_an_interrupted_snapshot_can_be_repeated(spark, monkeypatch):
    parts, path = extracts(4), scratch(spark, "history")
    frames = [spark.createDataFrame(p, SCHEMA) for p in parts]
    store = BucketedHistory(spark, path, frames[0].schema, "id", ["a", "b"], buckets=3)
    store.snapshot(frames[0], TIMES[0])
    put = store._put

    def stop(df, name, snapshot):
        if name == "heads":
            raise RuntimeError("lost")
        put(df, name, snapshot)

    monkeypatch.setattr(store, "_put", stop)
    with pytest.raises(RuntimeError):
        store.snapshot(frames[1], TIMES[1])
    assert found(store) == defined(parts[:1])
    monkeypatch.setattr(store, "_put", put)
    store.snapshot(frames[1], TIMES[1])
    assert found(store) == defined(parts[:2])


def test_the_session_may_overwrite_statically(spark):
    parts, path = extracts(5), scratch(spark, "history")
    frames = [spark.createDataFrame(p, SCHEMA) for p in parts]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        store = BucketedHistory(spark, path, frames[0].schema, "id", ["a", "b"], buckets=3)
        for k, (df, at) in enumerate(zip(frames, TIMES)):
            if k == 2:  # tables declared without a mode of their own are given one
                for name in store.names.values():
                    spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES "
                              "('partitionOverwriteMode' = 'static')")
                store = BucketedHistory(spark, path, frames[0].schema, "id", ["a", "b"], buckets=3)
            store.snapshot(df, at)
            assert found(store) == defined(parts[:k + 1])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
