"""Strings that powers of one base modulo 2**64 cannot tell apart, in every user of range hashes."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from delaylens.llm import kernels, rules, substrings, tokens
from delaylens.llm.common import vocabulary_path
from tests.llm.helpers import kept_words, rule_counts, sha


def thue_morse(n=11):
    word = "a"
    for _ in range(n):
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


ONE, OTHER = thue_morse()


def test_range_hashes_differ():
    values = np.frombuffer((ONE + OTHER).encode(), np.uint8)
    a, b = kernels.range_hashes(values, np.array([0, len(ONE)]), np.array([len(ONE), len(values)]))
    assert a != b


def clash(monkeypatch):
    """Make all hashes of equal length equal, so that only comparing content can help."""
    def same(values, starts, ends):
        return (ends - starts).astype(np.uint64)
    for module in (kernels, rules, substrings):
        monkeypatch.setattr(module, "range_hashes", same)


def test_groups_of_equal_hashes_are_told_apart(monkeypatch):
    clash(monkeypatch)
    text = f"{ONE}\n{OTHER}\n{ONE}\nx y z x y z z y x"
    counts, _ = rules.measured(kernels.texts_of(pa.array([text, text])))
    want = rule_counts(text)
    for k, name in enumerate(rules.COUNTS):
        assert counts[name].tolist() == [want[k]] * 2


def test_encoding_does_not_trust_the_memo(monkeypatch):
    from tokenizers import Tokenizer

    from delaylens.llm.bpe import Encoder
    library = Tokenizer.from_file(vocabulary_path())
    texts = [ONE, OTHER, "ab ba ab", "cd dc", ""]
    for broken in (False, True):
        if broken:
            clash(monkeypatch)
        encoder = Encoder(vocabulary_path())
        for batch in ([texts[0]], [texts[1]], texts):  # across batches, and in one
            ids, counts = encoder.encode_all(batch)
            want = [library.encode(t, add_special_tokens=False).ids for t in batch]
            assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == list(map(len, want))


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 1}, {"hot_rows": 1, "bucket_rows": 1}])
def test_windows_of_look_alikes_stay(spark, sizes):
    filler = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(filler[:30] + [ONE] + filler[30:])),
            (2, " ".join(filler[:30] + [OTHER] + filler[30:])),
            (3, " ".join(filler)), (4, " ".join(filler + ["end"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.digests(df, **sizes).collect()}
    for (i, _), (words, kept) in zip(rows, kept_words(rows)):
        assert got[i].n_removed == len(words) - len(kept)
        assert got[i].kept_sha256 == sha(" ".join(kept))


def test_token_files_of_look_alikes(spark):
    from delaylens.session import scratch
    rows = [(1, ONE), (2, OTHER), (3, f"{OTHER} {ONE}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = tokens.decode(tokens.encode(df, vocabulary_path()).select("doc_id", "ids"), vocabulary_path())
    assert {r.doc_id: r.decoded for r in out.collect()} == dict(rows)
    folder = scratch(spark, "tokens")
    tokens.write_tokens(df, folder, vocabulary_path())
    read = {r.doc_id: r.ids for r in tokens.read_tokens(spark, folder).collect()}
    assert len({hashlib.sha256(repr(v).encode()).digest() for v in read.values()}) == 3
