"""Every stage of the pipeline against its brute-force version on the stage's own input."""

import hashlib

import numpy as np

import corpus_pipeline
from delaylens.llm import bpe
from delaylens.llm.common import vocabulary_path
from tests.llm.helpers import (
    SCHEMA, bench_hits, documents, fingerprint, groups, kept_words, rule_counts,
)


def put(spark, path, docs, labels, bench):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, tmp_path):
    docs = documents()
    junk = [(1000 + k, " ".join(f"W{k}X{j}###$$$" for j in range(80)), "en", "s", 0) for k in range(8)]
    labels = [(i, int(i < 1000), 0) for i, *_ in docs + junk if i is not None]
    bench = [(1, " ".join(docs[-1][1].split()[20:34])), (2, "never seen")]
    sf = put(spark, tmp_path / "in", docs + junk, labels, bench)
    path = str(tmp_path / "at")
    spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "kept").withColumnRenamed(
        "lang", "n_hit").write.parquet(path + "0")
    steps = [spark.read.parquet(path + "0")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, steps[-1], sf).write.parquet(f"{path}{k + 1}")
        steps.append(spark.read.parquet(f"{path}{k + 1}"))
    assert all(s.columns == steps[0].columns for s in steps[:5])
    rows = [[(r.doc_id, r.text) for r in s.collect()] for s in steps[:5]]

    assert {i for i, _ in rows[0]} - {i for i, _ in rows[1]} >= {1000 + k for k in range(8)}
    assert all(not rule_counts(t)[5] for _, t in rows[1])
    assert {200 + k for k in range(20)} <= {i for i, _ in rows[1]}

    roots = groups([fingerprint(t) for _, t in rows[1]])
    key = lambda r: (r[0] is None, r[0] or 0)
    best = {}
    for row, root in zip(rows[1], roots):
        best[root] = min(best.get(root, row), row, key=key)
    assert sorted(map(key, rows[2])) == sorted(map(key, best.values()))

    want = sorted((key((i,)), (t or "") if len(w) == len(k) else " ".join(k))
                  for (i, t), (w, k) in zip(rows[2], kept_words(rows[2])))
    assert sorted((key((i,)), t or "") for i, t in rows[3]) == want
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())

    left = sorted(map(key, (r for r in rows[3] if not bench_hits(r[1], bench)[1])))
    assert sorted(map(key, rows[4])) == left and len(rows[4]) < len(rows[3])

    coder = bpe.load(vocabulary_path())
    texts = dict(rows[4])
    for r in steps[5].collect():
        ids = coder.tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert steps[5].count() == len(rows[4])
    assert corpus_pipeline.run(spark, sf).count() == len(rows[4])


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, put(spark, tmp_path / "e", [], [], [])).count() == 0
