import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from delaylens.llm import bpe, kernels, queries, tokens
from delaylens.llm.common import vocabulary_path
from tests.llm.helpers import SCHEMA, WORD, documents

PATH = vocabulary_path()
CODER = bpe.load(PATH)
ALPHABET = ["a", "b", "re", "ll", "ve", "s", "'", "''", " ", "  ", "\n", "\t", " '", "é", "1", "!",
            "\x85", "\xa0", "\x1c", "the", "ing", "<|endoftext|>", "中", "😀", "x" * 40]


def library(text):
    return CODER.tok.encode(text, add_special_tokens=False).ids


def test_words_are_those_of_the_pattern():
    texts = ["a b", None, "", " x y \n", "été\tz\x0b", "\x85"]
    got = kernels.texts_of(pa.array(texts))
    starts, ends, first = got.words()
    for i, t in enumerate(texts):
        words = [got.data[a:b].tobytes().decode() for a, b in zip(
            starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])]
        assert words == WORD.findall(t or "")


def test_range_hashes_follow_content():
    data = np.frombuffer(b"abcXabcYab", np.uint8)
    h = kernels.range_hashes(data, np.array([0, 4, 8, 0]), np.array([3, 7, 10, 2]))
    assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2]


def test_sliding_minimum():
    v = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    assert kernels.sliding_minimum(v, 3).tolist() == [min(v[i:i + 3]) for i in range(5)]
    assert len(kernels.sliding_minimum(v, 8)) == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join))
def test_encoding_is_the_librarys(text):
    ids, counts = CODER.encode_all([text])
    assert ids.tolist() == library(text)
    assert CODER.decode_all(ids, counts)[0].decode() == CODER.tok.decode(
        ids.tolist(), skip_special_tokens=False)


def test_batches_and_memo():
    rng = random.Random(2)
    texts = ["".join(rng.choice(ALPHABET[:-4]) for _ in range(rng.randint(0, 20))) for _ in range(500)]
    for _ in range(2):
        ids, counts = CODER.encode_all(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == list(map(library, texts))


@pytest.mark.parametrize("leaf", [5, 64, 512])
def test_tree_concatenation_of_unsplit_text(leaf):
    rng = random.Random(leaf)
    for text in ("a" * 1500, "ab" * 700, "".join(rng.choice("aeinrst") for _ in range(2000)),
                 "é" * 600, "-" * 900, " " * 800, "ing" * 400):
        assert CODER.encode_token(text, leaf).tolist() == library(text)


def test_leaves_of_a_long_text_join_exactly():
    text = "word " * 9000 + "q" * 70000 + "<|endoftext|>" + "\n" * 50000 + "don't" + "ab" * 30000
    parts = list(CODER.leaves(text))
    ids = [CODER.encode_leaf(data, bare) for data, bare, _ in parts]
    assert CODER.join_leaves(ids, [j for _, _, j in parts]).tolist() == library(text)
    assert len(parts) > 8


def test_encode_and_decode_rows(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "IDS")
    for long in (1 << 16, 20):
        encoded = tokens.encode(df, PATH, long=long)
        got = tokens.decode(encoded, PATH, sha="sha").collect()
        assert len(got) == len(rows)
        want = sorted((i or -1, t or "") for i, t, *_ in rows)
        assert sorted((r.doc_id or -1, r.decoded) for r in got) == want
        for r in got:
            assert list(r.ids) == library(r.text or "") and r.n_tokens == len(r.ids)
            assert r.sha == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    empty = tokens.encode(df.limit(0), PATH, long=20)
    assert tokens.decode(empty, PATH).count() == 0


def test_round_trip_is_decode_of_encode(spark):
    df = spark.createDataFrame(documents(), SCHEMA).withColumnRenamed("source", "IDS")
    row = lambda r: repr(tuple(r))
    for long in (1 << 16, 20):
        steps = tokens.encode(df.select("doc_id", "lang", "text"), PATH, long=long)
        want = tokens.decode(steps, PATH, sha="sha").drop("text")
        got = tokens.round_trip(df, PATH, ["doc_id", "lang"], sha="sha", long=long)
        assert got.schema == want.schema
        assert sorted(map(row, got.collect())) == sorted(map(row, want.collect()))
    got = tokens.round_trip(df, PATH, ["IDS", "text"], keep_ids=False, long=20)
    assert got.columns == ["text", "decoded"]  # a column named like the ids gives way to them
    assert all(r.decoded == (r.text or "") for r in got.collect())
    assert tokens.round_trip(df.limit(0), PATH, ["doc_id"], long=20).count() == 0


def test_a_task_has_one_worker_with_a_vocabulary(spark, tmp_path):
    """Workers that feed one another hold their memory at the same time."""
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for df in (corpus_pipeline.bpe_encoding(spark, docs, None), queries.op1(spark, tmp_path)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # short texts: one; long ones: leaves, their ids, joined ids, each behind an exchange or scan
        assert "Arrow" not in plan.split("Union")[0]
        assert plan.count("InArrow") == 4 and plan.count("Exchange") == 2


def test_token_files(spark, tmp_path):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    tokens.write_tokens(df, str(tmp_path / "t"), PATH)
    read = tokens.checksums(tokens.read_tokens(spark, str(tmp_path / "t")), ["doc_id", "start"])
    got = sorted(read.collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == len(rows)
    start, texts = 0, {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(library(t or "") + [0])
    for r in got:
        assert r.start == start
        start += r.n_tokens
        assert r.ids_crc32 in [zlib.crc32(np.array(x, "<u4").tobytes()) for x in texts[r.doc_id]]
    found = tokens.find_tokens(spark, str(tmp_path / "t"), [7]).collect()
    assert [list(r.ids) for r in found] == [library("one two") + [0]]
    tokens.write_tokens(df.limit(0), str(tmp_path / "e"), PATH)
    schema = spark.read.orc(str(tmp_path / "t")).schema
    assert spark.read.schema(schema).orc(str(tmp_path / "e")).count() == 0
