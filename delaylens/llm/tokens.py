"""Byte-pair encoding and decoding of documents, and token files.

``encode`` adds the ids of a text column. Texts up to ``LONG`` characters are encoded where they
are. Longer ones are cut into leaves that are encoded in parallel tasks and joined exactly
(``bpe.Encoder.join_leaves``), so one very long document does not hold up one task. Rows with
equal content are told apart by their count, so repeated documents stay repeated.
``round_trip`` decodes the ids in the worker that made them: a task then has one Python worker with
a vocabulary, where ``decode`` of ``encode`` has two at a time.

Null texts are empty; empty texts have no ids. A column named like an output is replaced.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from delaylens.llm import bpe
from delaylens.llm.common import appended, free_name, with_fields
from delaylens.llm.kernels import slices

LONG = 1 << 16
IDS = T.ArrayType(T.IntegerType(), True)


def id_lists(ids, counts):
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def flat_ids(column):
    """(ids of all rows, number of ids of each) of a list column; null lists are empty."""
    counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.uint32), counts


def encode(docs: DataFrame, path, text="text", out="ids", long=LONG) -> DataFrame:
    """Add ``out``, the ids of ``text`` under the vocabulary at ``path``."""
    return _encode(docs, path, text, out, long, with_fields(docs.schema, **{out: IDS}))


def _encode(docs, path, text, out, long, schema, then=lambda batches: batches):
    """``then`` makes ``schema`` of the encoded batches, in the task that ends their encoding."""
    def whole(batches):
        coder = bpe.load(path)
        for batch in slices(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).fill_null("").to_pylist()
            yield appended(batch, {out: id_lists(*coder.encode_all(texts))})

    size = F.coalesce(F.length(text), F.lit(0))
    short = docs.where(size <= long).mapInArrow(lambda batches: then(whole(batches)), schema)
    return short.unionByName(_encode_long(docs.where(size > long), path, text, out, schema, then))


def _encode_long(docs, path, text, out, schema, then):
    row, key, part, no, bare, joins = (free_name(docs, n) for n in (
        "row", "row_key", "part", "part_no", "bare", "joins"))
    others = [c for c in docs.columns if c.lower() != out.lower()]
    keyed = docs.select(F.struct(*others).alias(row)).withColumn(
        key, F.sha2(F.to_json(row), 256))
    whole_row = T.StructField(row, keyed.schema[row].dataType, True)  # null but for the first part
    cut_schema = T.StructType([
        whole_row, T.StructField(key, T.StringType()), T.StructField(no, T.IntegerType()),
        T.StructField(part, T.BinaryType()), T.StructField(bare, T.BooleanType()),
        T.StructField(joins, T.BooleanType())])

    def cut_up(batches):
        coder = bpe.load(path)
        for batch in batches:
            rows, keys = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                parts = list(coder.leaves(rows.field(text)[i].as_py()))
                n = len(parts)
                take = pa.array([i] + [None] * (n - 1), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.take(take), pa.array([keys[i].as_py()] * n),
                     pa.array(range(n), pa.int32()), pa.array([p[0] for p in parts], pa.binary()),
                     pa.array([p[1] for p in parts]), pa.array([p[2] for p in parts])],
                    names=[row, key, no, part, bare, joins])

    def encode_parts(batches):
        coder = bpe.load(path)
        for batch in batches:
            got = [coder.encode_leaf(d, b) for d, b in zip(
                batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            flat = np.concatenate(got) if got else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(5),
                 id_lists(flat, np.array([len(g) for g in got], np.int64))],
                names=[row, key, no, joins, out])

    def join_up(group: pa.Table) -> pa.Table:
        """All leaves of one document (repeated documents: of all its copies)."""
        coder = bpe.load(path)
        first, at = {}, group.column(no).to_pylist()
        for i, n in enumerate(at):
            first.setdefault(n, i)
        order = [first[n] for n in sorted(first)]
        lists, onto = group.column(out), group.column(joins)
        ids = coder.join_leaves([lists[i].values.to_numpy() for i in order],
                                [onto[i].as_py() for i in order])
        copies = [i for i, n in enumerate(at) if n == 0]
        rows = group.column(row).combine_chunks().take(pa.array(copies, pa.int64()))
        counts = np.full(len(copies), len(ids), np.int64)
        joined = pa.RecordBatch.from_arrays(
            [rows.field(f) for f in others] + [id_lists(np.tile(ids, len(copies)), counts)],
            names=[*others, out])
        return pa.Table.from_batches(list(then([joined])))

    parted = keyed.mapInArrow(cut_up, cut_schema).repartition(F.col(key), F.col(no))
    encoded = parted.mapInArrow(encode_parts, T.StructType([
        whole_row, T.StructField(key, T.StringType()), T.StructField(no, T.IntegerType()),
        T.StructField(joins, T.BooleanType()), T.StructField(out, IDS)]))
    return encoded.groupBy(key).applyInArrow(join_up, schema)


def decode(encoded: DataFrame, path, ids="ids", out="decoded", keep_ids=True,
           sha=None) -> DataFrame:
    """Add ``out``, the text of ``ids``, special tokens included; null ids give an empty text.

    ``sha`` names columns for the number of ids and their digest, made in the same pass.
    """
    return encoded.mapInArrow(*_decoder(
        encoded.schema, path, ids, out, sha, () if keep_ids else (ids,)))


def round_trip(docs: DataFrame, path, keep=(), text="text", ids="ids", out="decoded",
               keep_ids=True, sha=None, long=LONG) -> DataFrame:
    """The ``keep`` columns of ``encode``, then ``decode``, of ``text`` in one pass."""
    source = docs.select(*dict.fromkeys([*keep, text]))
    unused = [c for c, kept in ((text, text in keep or text == ids), (ids, keep_ids)) if not kept]
    then, schema = _decoder(
        with_fields(source.schema, **{ids: IDS}), path, ids, out, sha, unused)
    return _encode(source, path, text, ids, long, schema, then)


def _decoder(schema, path, ids, out, sha, unused):
    """(function over batches of ``schema``, its output's schema, without the unused columns)."""
    extra = {out: T.StringType()}
    extra |= {"n_tokens": T.LongType(), sha: T.StringType()} if sha else {}
    base = T.StructType([f for f in schema.fields if f.name not in unused])

    def run(batches):
        coder = bpe.load(path)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            kept = [i for i, n in enumerate(batch.schema.names) if n not in unused]
            for row in range(0, batch.num_rows, 250):
                part = batch.slice(row, 250)
                flat, counts = flat_ids(part.column(at))
                texts = coder.decode_all(flat, counts)
                cols = {out: pa.array(texts, pa.binary()).cast(pa.string())}
                if sha:
                    cols |= {"n_tokens": pa.array(counts),
                             sha: pa.array(_each(flat, counts, _sha256), pa.string())}
                yield appended(part.select(kept), cols)

    return run, with_fields(base, **extra)


def _sha256(data):
    return hashlib.sha256(data).hexdigest()


def _each(flat, counts, digest):
    """Digest of each run of ids as little-endian unsigned 32-bit integers."""
    data = memoryview(flat.astype("<u4").view(np.uint8))
    ends = np.cumsum(counts).tolist()
    return [digest(data[4 * a:4 * b]) for a, b in zip([0, *ends], ends)]


def checksums(encoded: DataFrame, keep=(), ids="ids", out="ids_crc32") -> DataFrame:
    """``n_tokens`` and the crc32 of the ids of every row."""
    source = encoded.select(*keep, ids)

    def run(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                flat, counts = flat_ids(part.column(part.num_columns - 1))
                yield appended(part.select(range(part.num_columns - 1)), {
                    "n_tokens": pa.array(counts),
                    out: pa.array(_each(flat, counts, zlib.crc32), pa.int64())})

    return source.mapInArrow(run, with_fields(
        source.drop(ids).schema, n_tokens=T.LongType(), **{out: T.LongType()}))


# --- token files ----------------------------------------------------------------------

#: Rows of a row-index entry (the unit that readers skip) and false positives of the filters.
INDEX_ROWS = 1000
BLOOM_FPP = 0.01


def write_tokens(docs: DataFrame, folder, path, end_id=0, doc_id="doc_id", text="text",
                 stripe_mb=16, compression="zstd"):
    """Write the ids of all documents, each followed by ``end_id``, as ORC files in id order.

    Documents are dealt out by ranges of (id, hash of the text), so equal ids may be split, and
    sorted within each file (nulls first). Columns: ``doc_id``, ``ids`` (integer run-length
    encoded by the format), ``n_tokens``, ``part`` (order of the file) and ``before`` (ids of
    earlier documents of the file). Stripes can be read in parallel; row indexes and Bloom filters
    on ``doc_id`` let readers skip stripes and row groups.
    """
    tie = F.xxhash64(text)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = source.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    schema = T.StructType([
        source.schema["doc_id"], T.StructField("ids", IDS), T.StructField("n_tokens", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType())])

    def run(batches):
        coder, before = bpe.load(path), 0
        part = TaskContext.get().partitionId()
        for batch in slices(batches):
            ids, counts = coder.encode_all(batch.column(1).fill_null("").to_pylist())
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), id_lists(ids, counts), pa.array(counts),
                 pa.array(np.full(len(counts), part, np.int32)), pa.array(starts)],
                names=schema.names)

    (ordered.mapInArrow(run, schema).write.option("compression", compression)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(BLOOM_FPP))
     .option("orc.row.index.stride", str(INDEX_ROWS))
     .option("orc.stripe.size", str(stripe_mb << 20)).orc(folder))


def read_tokens(spark, folder) -> DataFrame:
    """The documents of token files with ``start``, the number of ids of all earlier documents.

    Only one number per file goes through a single task and is broadcast: 12 bytes for a file of
    one task's share of the documents, so 100 TB of 100 MB files make 12 MB.
    """
    files = spark.read.orc(folder)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    return files.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids")


def find_tokens(spark, folder, doc_ids) -> DataFrame:
    """Ids of the given documents; stripes and row groups without them are skipped."""
    return spark.read.orc(folder).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "ids")
