"""Language-model scores from a weighted backoff automaton over word bigrams.

The model is a bigram model with Dirichlet smoothing: with ``c`` counting in the training texts,

    P(w)     = (c(w) + 1) / (N + V + 1)
    P(w | h) = (c(h w) + weight * P(w)) / (c(h) + weight)

over lower-cased (A-Z) words and one end per text; ``h`` is the word before, or the start of the text.
As an automaton, every history is a state with one arc per seen continuation; its failure arc, of
weight ``weight / (c(h) + weight)``, leads to the root, which has an arc for every word. Reading a
text is one traversal from left to right that carries the state and adds up log10 probabilities.

The automaton of a large corpus fits no machine, so it is dealt out. ``tokenise`` writes the documents
as blocks of a few MB, with a dictionary each. A block asks for the counts of its own distinct words
and word pairs; the requests go as packed rows to buckets by a hash of the word or pair, so a
frequent word is one entry of each block and no key is hot. A bucket adds up the requests, which hold
what the block counted itself in training texts, and answers each block in the order it asked.
Answers meet their block again, which builds its part of the automaton: all states and arcs that
its texts can reach. Words are compared as strings, so counts are exact.

A null text is empty and has only its end. A missing id counts as empty text in the split; repeated
ids are scored one by one. Other columns are not carried. Without training texts N and V are 0, all
probabilities of words are 1 and the score is 0. An empty table gives an empty table.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.llm.common import stored
from delaylens.llm.kernels import mixed, range_hashes, slices

#: Text in a block; tokens of the corpus for each bucket.
BLOCK_BYTES = 4_000_000
BUCKET_TOKENS = 800_000
#: Pseudo-counts of the lower order in each history.
WEIGHT = 500.0

BLOCKS = ("block string, ids {ids}, train binary, lengths binary, words binary, tokens binary, "
          "n_tokens long, n_train long")
ASKED = "bucket long, block string, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWERED = ("block string, bucket long, word_counts binary, pair_counts binary, n_tokens long, "
            "n_types long")


# --- packed columns -------------------------------------------------------------

def packed(values):
    """Integers as compressed bytes."""
    raw = np.ascontiguousarray(values, np.int64).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data):
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.int64)


def packed_strings(strings):
    """A string array as compressed bytes."""
    strings = strings.cast(pa.large_string())
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + len(strings) + 1] if (
        len(strings)) else np.zeros(1, np.int64)
    body = data.to_pybytes()[offsets[0]:offsets[-1]] if data is not None else b""
    lengths = packed(np.diff(offsets))
    text = pa.compress(body, codec="zstd", asbytes=True)
    return b"".join(n.to_bytes(8, "little") for n in (len(lengths), len(body))) + lengths + text


def unpacked_strings(data):
    n_lengths, n_body = (int.from_bytes(data[i:i + 8], "little") for i in (0, 8))
    lengths = unpacked(data[16:16 + n_lengths])
    body = pa.decompress(data[16 + n_lengths:], n_body, codec="zstd", asbytes=True)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        len(lengths), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body))


# --- blocks ---------------------------------------------------------------------

def words_of(texts):
    """(words of all texts in a row, number of words of each text); A-Z in lower case."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("").cast(pa.large_string())))
    words, of = split.flatten(), pc.list_parent_indices(split)
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), np.bincount(of.filter(full).to_numpy(), minlength=len(texts))


def pairs_of(tokens, lengths, start):
    """(state before, token) of every token; ``start`` precedes the first of each text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return before, tokens


def tokenise(docs: DataFrame, train, doc_id="doc_id", text="text",
             block_bytes=BLOCK_BYTES) -> DataFrame:
    """Blocks of documents: a dictionary, and the texts as its indices, each with an end.

    The end has index ``len(words)``. ``train`` is a column, true for documents to learn from.
    """
    ids = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(train, F.lit(False)).alias("train"),
                       F.col(text).alias("text"), F.expr("uuid()").alias("block"))

    def pieces(batches):
        held, size = [], 0
        for piece in slices(batches, "text", block_bytes):
            held.append(piece)
            size += piece.column(2).nbytes
            if size >= block_bytes:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches):
        for table in pieces(batches):
            words, n_words = words_of(table["text"].combine_chunks())
            coded = words.dictionary_encode()
            end = len(coded.dictionary)
            lengths = n_words + 1
            tokens = np.full(int(lengths.sum()), end, np.int64)
            inner = np.ones(len(tokens), bool)
            inner[np.cumsum(lengths) - 1] = False
            tokens[inner] = coded.indices.to_numpy()
            train = table["train"].to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array([table["block"][0].as_py()]),
                pa.array([table["id"].to_pylist()], pa.list_(table["id"].type)),
                pa.array([packed(train)]), pa.array([packed(lengths)]),
                pa.array([packed_strings(coded.dictionary)]), pa.array([packed(tokens)]),
                pa.array([len(tokens)]), pa.array([int(train.sum())])],
                names=["block", "ids", "train", "lengths", "words", "tokens", "n_tokens", "n_train"])

    return rows.mapInArrow(run, BLOCKS.format(ids=T.ArrayType(ids).simpleString()))


class Block:
    """A block's texts, with its distinct words and pairs and the buckets they belong to."""

    def __init__(self, train, lengths, words, tokens, buckets):
        self.train, self.lengths = unpacked(train).astype(bool), unpacked(lengths)
        self.words, self.tokens = unpacked_strings(words), unpacked(tokens)
        self.end = len(self.words)
        before, after = pairs_of(self.tokens, self.lengths, self.end)
        self.pairs = before * (self.end + 1) + after
        self.keys = np.unique(self.pairs)
        _, offsets, data = self.words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[:self.end + 1]
        hashes = np.append(range_hashes(np.frombuffer(data, np.uint8), offsets[:-1], offsets[1:]),
                           np.uint64(0))
        self.word_bucket = (mixed(hashes[:-1]) % np.uint64(buckets)).astype(np.int64)
        both = mixed(hashes[self.keys // (self.end + 1)] + np.uint64(1)) ^ hashes[
            self.keys % (self.end + 1)]
        self.pair_bucket = (mixed(both) % np.uint64(buckets)).astype(np.int64)

    def own_counts(self):
        """How often the training texts of the block have each of its words and pairs."""
        learnt = np.repeat(self.train, self.lengths)
        found, times = np.unique(self.pairs[learnt], return_counts=True)
        pair_counts = np.zeros(len(self.keys), np.int64)
        pair_counts[np.searchsorted(self.keys, found)] = times
        return np.bincount(self.tokens[learnt], minlength=self.end + 1)[:self.end], pair_counts

    def by_bucket(self):
        """(bucket, its words, its pairs) as indices, in a fixed order."""
        words = np.argsort(self.word_bucket, kind="stable")
        pairs = np.argsort(self.pair_bucket, kind="stable")
        found = np.union1d(self.word_bucket, self.pair_bucket)
        cuts = [np.searchsorted(b, found, side) for b in (
            self.word_bucket[words], self.pair_bucket[pairs]) for side in ("left", "right")]
        for k, bucket in enumerate(found):
            yield int(bucket), words[cuts[0][k]:cuts[1][k]], pairs[cuts[2][k]:cuts[3][k]]

    def pair_strings(self, at):
        """Pairs as 'history word'; the start, and the end, are empty strings."""
        words = pa.concat_arrays([self.words, pa.array([""], pa.large_string())])
        keys = self.keys[at]
        return pc.binary_join_element_wise(
            words.take(pa.array(keys // (self.end + 1))),
            words.take(pa.array(keys % (self.end + 1))), pa.scalar(" ", pa.large_string()))


def requests(blocks: DataFrame, buckets) -> DataFrame:
    """One packed row per block and bucket: its distinct words and pairs with their own counts."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["train"], row["lengths"], row["words"], row["tokens"], buckets)
                word_counts, pair_counts = block.own_counts()
                for bucket, words, pairs in block.by_bucket():
                    yield pa.RecordBatch.from_pylist([{
                        "bucket": bucket, "block": row["block"],
                        "words": packed_strings(block.words.take(pa.array(words))),
                        "word_counts": packed(word_counts[words]),
                        "pairs": packed_strings(block.pair_strings(pairs)),
                        "pair_counts": packed(pair_counts[pairs])}])

    return blocks.select("block", "train", "lengths", "words", "tokens").mapInArrow(run, ASKED)


def answers(asked: DataFrame) -> DataFrame:
    """Total counts of what each block asked for; the first row of a bucket has its totals."""
    def totals(strings, counts):
        """(total of each asked string, its cuts by row, totals of the distinct ones)."""
        parts = [unpacked_strings(s) for s in strings]
        own = [unpacked(c) for c in counts]
        coded = pa.concat_arrays(parts).dictionary_encode()
        at = coded.indices.to_numpy()
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, at, np.concatenate(own))
        return total[at], np.cumsum([len(c) for c in own])[:-1], total

    def run(table):
        table = table.combine_chunks()
        words, word_cuts, every = totals(
            table["words"].to_pylist(), table["word_counts"].to_pylist())
        pairs, pair_cuts, _ = totals(table["pairs"].to_pylist(), table["pair_counts"].to_pylist())
        rest = [0] * (table.num_rows - 1)
        return pa.table({
            "block": table["block"], "bucket": table["bucket"],
            "word_counts": [packed(c) for c in np.split(words, word_cuts)],
            "pair_counts": [packed(c) for c in np.split(pairs, pair_cuts)],
            "n_tokens": pa.array([int(every.sum())] + rest),
            "n_types": pa.array([int((every > 0).sum())] + rest)})

    return asked.groupBy("bucket").applyInArrow(run, ANSWERED)


# --- the automaton --------------------------------------------------------------

class Automaton:
    """States 0 (root), 1 (start) and 2 + word; arcs of a state by token; failure arcs to the root."""

    ROOT, START = 0, 1

    def __init__(self, word_counts, keys, pair_counts, n_docs, n_tokens, n_types, weight):
        """``word_counts`` by token with the end last; ``keys`` are history * tokens + token."""
        self.n = n = len(word_counts)
        counts = word_counts.astype(float)
        chance = (counts + 1) / (n_tokens + n_types + 1)
        self.root = np.log10(chance)
        seen = np.append(np.where(word_counts[:-1] > 0, np.arange(2, n + 1), self.ROOT), self.ROOT)
        self.next = seen
        history = np.concatenate([[0.0, n_docs], counts[:-1]])
        self.failure = np.log10(weight / (history + weight))
        arc = pair_counts > 0
        before, after = keys[arc] // n, keys[arc] % n
        state = np.where(before == n - 1, self.START, before + 2)
        order = np.lexsort([after, state])
        self.arcs = (state * n + after)[order]
        self.weights = np.log10((pair_counts[arc] + weight * chance[after])
                                / (history[state] + weight))[order]

    def step(self, state, token):
        """Log10 probability of reading each token in each state: by an arc, or over the failure arc."""
        fallen = self.failure[state] + self.root[token]
        if not len(self.arcs):
            return fallen
        key = state * self.n + token
        at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
        return np.where(self.arcs[at] == key, self.weights[at], fallen)

    def read(self, tokens, lengths):
        """Log10 probability of each text.

        The state after a token is the token's own history state (or the root, if it never was one),
        so the states of a traversal are known beforehand and all its steps are taken at once.
        """
        first = np.cumsum(lengths) - lengths
        state = np.empty_like(tokens)
        state[1:] = self.next[tokens[:-1]]
        state[first] = self.START
        return np.add.reduceat(self.step(state, tokens), first)


def score(docs: DataFrame, train, doc_id="doc_id", text="text", weight=WEIGHT,
          block_bytes=BLOCK_BYTES, bucket_tokens=BUCKET_TOKENS) -> DataFrame:
    """``doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    blocks = stored(tokenise(docs, train, doc_id, text, block_bytes), "lm-blocks")
    total = blocks.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_train").alias("docs")).first()
    buckets = max(1, -(-(total["tokens"] or 0) // bucket_tokens))
    n_docs = total["docs"] or 0
    replies = stored(answers(requests(blocks, buckets)), "lm-answers")
    size = replies.agg(F.sum("n_tokens").alias("n"), F.sum("n_types").alias("v")).first()
    n_tokens = (size["n"] or 0) + n_docs
    n_types = (size["v"] or 0) + (n_docs > 0)
    of = docs.schema[doc_id].dataType.simpleString()

    def run(left, right):
        out = []
        answer = {r["bucket"]: r for r in right.select(
            ["bucket", "word_counts", "pair_counts"]).to_pylist()}
        for row in left.to_pylist():
            block = Block(row["train"], row["lengths"], row["words"], row["tokens"], buckets)
            words = np.zeros(block.end + 1, np.int64)
            words[-1] = n_docs
            pairs = np.zeros(len(block.keys), np.int64)
            for bucket, w, p in block.by_bucket():
                words[w] = unpacked(answer[bucket]["word_counts"])
                pairs[p] = unpacked(answer[bucket]["pair_counts"])
            machine = Automaton(words, block.keys, pairs, n_docs, n_tokens, n_types, weight)
            ends = np.cumsum(block.lengths)
            cuts = ends - block.lengths
            out.append(pa.table({
                "id": pa.array(row["ids"], left.schema.field("ids").type.value_type),
                "learnt": block.train, "n_tokens": block.lengths,
                "n_known": np.add.reduceat((words > 0)[block.tokens].astype(np.int64), cuts),
                "train_tokens": np.full(len(ends), n_tokens),
                "base_score": np.add.reduceat(machine.root[block.tokens], cuts),
                "score": machine.read(block.tokens, block.lengths)}))
        return pa.concat_tables(out)

    schema = (f"id {of}, learnt boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    return blocks.drop("n_tokens", "n_train").groupBy("block").cogroup(
        replies.groupBy("block")).applyInArrow(run, schema).withColumnRenamed("id", doc_id)


#: The query's rows by definition, scores to six decimals; documents by row, as ids may repeat.
ORACLE = f"""
WITH RECURSIVE tab AS (SELECT i AS byte, 0 AS k, i AS c FROM range(256) t(i) UNION ALL
  SELECT byte, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END
  FROM tab WHERE k < 8),
step AS (SELECT byte, c FROM tab WHERE k = 8),
docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
  coalesce(CAST(doc_id AS VARCHAR), '') AS id FROM documents),
sums AS (SELECT row, id, 0 AS k, 4294967295 AS c FROM docs UNION ALL
  SELECT row, id, k + 1, xor(sums.c >> 8, step.c) FROM sums
    JOIN step ON step.byte = xor(sums.c & 255, ascii(substr(id, k + 1, 1))) WHERE k < length(id)),
split AS MATERIALIZED (SELECT row, xor(c, 4294967295) % 7 = 2 AS held_out FROM sums
  WHERE k = length(id)),
listed AS (SELECT row, doc_id, held_out, list_append(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), '') AS ws
  FROM docs JOIN split USING (row)),
tok AS MATERIALIZED (SELECT row, doc_id, held_out, unnest(ws) AS w,
  unnest(list_prepend(CAST(NULL AS VARCHAR), ws[:-2])) AS h FROM listed),
uni AS MATERIALIZED (SELECT w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY w),
pair AS (SELECT h, w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY h, w),
total AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v,
  (SELECT count(*) FROM split WHERE NOT held_out) AS starts FROM uni),
scored AS (SELECT row, doc_id, held_out, coalesce(uni.c, 0) AS c, coalesce(pair.c, 0) AS hw, n,
    (coalesce(uni.c, 0) + 1) / (n + v + 1) AS p,
    CASE WHEN tok.h IS NULL THEN starts ELSE coalesce(before.c, 0) END AS h
  FROM tok CROSS JOIN total LEFT JOIN uni ON uni.w = tok.w LEFT JOIN uni before ON before.w = tok.h
    LEFT JOIN pair ON pair.w = tok.w AND pair.h IS NOT DISTINCT FROM tok.h)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens,
  count_if(c > 0)::BIGINT AS n_known, any_value(n)::BIGINT AS train_tokens,
  round(sum(log10(p)), 6) AS base_score,
  round(sum(log10((hw + {WEIGHT} * p) / (h + {WEIGHT}))), 6) AS score
FROM scored GROUP BY row, doc_id"""
