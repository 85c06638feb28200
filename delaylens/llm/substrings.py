"""Exact removal of long passages that repeat across documents, by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the smallest hash of ``minimiser`` words
in it; consecutive windows that share one travel together as one packed string (a super-k-mer) to
the bucket of the minimiser, where windows are sorted and counted exactly.

1. One pass over the texts stores the minimiser runs of every document, without words.
2. Minimisers that occur in one document only cannot repeat; the others keep their runs.
3. Only documents with such runs send packed strings. A bucket holds a bounded number of them.
4. A minimiser with more than ``hot_rows`` runs is dealt over salted groups: each reduces its
   windows to (hash, smallest id, largest id), these are merged by ranges of the hash, and the
   hashes that occur under two ids go back to every salted group. Only a filter so far: each salted
   group then sends the words of its windows with such hashes, once, to groups by hash, where
   they are compared as bytes, and gets back the smallest id of exactly these words.

Each of these steps is stored, and its shuffle files go, before the next one begins; stored
tables are merged with the texts whatever their size, as a broadcast would grow with the input.

Every window whose words also start in a document with a smaller id is removed with all words it
covers; windows are judged on the input. Null texts have no words. A null id counts as larger than
all others, and equal ids never remove each other's words. Texts without removed words stay as
they are; others become their kept words joined by single spaces.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.llm.common import appended, stored, with_fields
from delaylens.llm.kernels import (
    exact_groups, mixed, range_hashes, same_ranges, sequence_hashes, slices, sliding_minimum, spread,
    texts_of,
)

WINDOW = 50
MINIMISER = 8
#: Windows of one packed string, packed strings of a bucket, and runs from which a key is salted.
RUN = 64
BUCKET_ROWS = 4000
HOT_ROWS = 2000
#: Packed strings whose windows are spelt out at once (more only if one minimiser has them).
PART_ROWS = 500
NO_ID = (1 << 63) - 1


def runs_of(texts, window, size):
    """(text, minimiser, first word in its text, number of windows) of every run, and word counts."""
    starts, ends, first = texts.words()
    n_words = np.diff(first)
    none = np.zeros(0, np.int64)
    if len(starts) < window:
        return none, none, none, none, n_words
    grams = sequence_hashes(range_hashes(texts.data, starts, ends), size)
    least = sliding_minimum(grams, window - size + 1)
    text_of = np.repeat(np.arange(len(texts)), n_words)
    valid = np.flatnonzero(text_of[:len(least)] == text_of[window - 1:])
    if not len(valid):
        return none, none, none, none, n_words
    value = least[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (value[1:] != value[:-1]) | (valid[1:] != valid[:-1] + 1)
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(valid)))
    pieces = -(-length // RUN)
    nth = spread(np.zeros(len(at), np.int64), pieces)
    begin = np.repeat(at, pieces) + nth * RUN
    size_of = np.minimum(np.repeat(length, pieces) - nth * RUN, RUN)
    text = text_of[valid[begin]]
    return text, value[begin].view(np.int64), valid[begin] - first[text], size_of, n_words


def packed(texts):
    """The words of each text joined by single spaces, and the words' bounds in that buffer."""
    starts, ends, first = texts.words()
    length = ends - starts
    padded = np.append(texts.data, np.uint8(32))
    data = padded[spread(starts, length + 1)]
    after = np.cumsum(length + 1)
    if len(after):
        data[after - 1] = 32
    return data, after - 1 - length, after - 1, first


def binaries(data, starts, ends):
    length = ends - starts
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[spread(starts, length)]))])


def windows_of(strings, window):
    """(data, starts, ends, hash, string index) of all windows of distinct packed strings."""
    texts = texts_of(strings.cast(pa.large_binary()).view(pa.large_string()))
    starts, ends, first = texts.words()
    count = np.maximum(np.diff(first) - window + 1, 0)
    at = spread(first[:-1], count)
    lo, hi = starts[at], ends[at + window - 1]
    return texts.data, lo, hi, range_hashes(texts.data, lo, hi), np.repeat(np.arange(len(texts)), count)


def window_groups(data, starts, ends, hashes):
    """Group number of each window, equal exactly for equal words."""
    return exact_groups(hashes, lambda a, b: same_ranges(data, starts, ends, a, b),
                        lambda i: data[starts[i]:ends[i]].tobytes())


def distinct_strings(group):
    """(distinct packed strings, index of each row's) of a group of rows."""
    coded = group.column("packed").combine_chunks().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def least_of(index, values, size, how=np.minimum, start=NO_ID):
    out = np.full(size, start, np.int64)
    how.at(out, index, values)
    return out


def removed_ranges(group, code, string_of, smallest, window):
    """Rows (rid, th, start, end) of words whose window starts in a document of smaller id."""
    rid = group.column("rid").to_numpy()
    count = np.bincount(string_of, minlength=int(code.max(initial=-1)) + 1)
    begin = np.cumsum(count) - count
    at = spread(begin[code], count[code])
    row = np.repeat(np.arange(len(code)), count[code])
    nth = at - begin[code][row]
    gone = np.flatnonzero(smallest[at] < rid[row])
    row, nth = row[gone], nth[gone]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (nth[1:] != nth[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(row)) - 1 if len(a) else a
    own, s = row[a], group.column("s").to_numpy()
    return pa.table({
        "rid": pa.array(rid[own]), "th": pa.array(group.column("th").to_numpy()[own]),
        "start": pa.array((s[own] + nth[a]).astype(np.int64)),
        "end": pa.array((s[own] + nth[b] + window).astype(np.int64))})


RANGES = "rid long, th long, start long, end long"


def _keyed(docs, doc_id, text):
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("rid"),
                       F.xxhash64(text).alias("th"), F.col(text).alias("text"))


def minimiser_runs(docs, window=WINDOW, size=MINIMISER) -> DataFrame:
    """One row per document: ``rid, th, n_words, kept_sha256`` of all words, and its runs."""
    runs = T.ArrayType(T.StructType([
        T.StructField("mh", T.LongType()), T.StructField("s", T.IntegerType()),
        T.StructField("r", T.IntegerType())]))
    schema = T.StructType([
        T.StructField("rid", T.LongType()), T.StructField("th", T.LongType()),
        T.StructField("n_words", T.LongType()), T.StructField("kept_sha256", T.StringType()),
        T.StructField("runs", runs)])

    def run(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(2))
            text, mh, s, r, n_words = runs_of(texts, window, size)
            offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays(
                [pa.array(mh), pa.array(s.astype(np.int32)), pa.array(r.astype(np.int32))],
                names=["mh", "s", "r"])
            data, a, b, first = packed(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words),
                 pa.array(_digests(data, a, b, first), pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets), items)], names=schema.names)

    return docs.mapInArrow(run, schema)


def _digests(data, starts, ends, first):
    out = []
    for a, b in zip(first[:-1], first[1:]):
        out.append(hashlib.sha256(data[starts[a]:ends[b - 1]] if b > a else b"").hexdigest())
    return out


def repeats(keyed: DataFrame, runs: DataFrame, window=WINDOW, bucket_rows=BUCKET_ROWS,
            hot_rows=HOT_ROWS):
    """(documents with possible repeats, ranges of removed words) from stored ``runs``."""
    flat = runs.select("rid", "th", F.explode("runs").alias("run")).select("rid", "th", "run.*")
    shared = flat.groupBy("mh").agg(
        F.min("rid").alias("lo"), F.max("rid").alias("hi"), F.count("*").alias("n")).where(
        "lo < hi").select("mh", F.when(F.col("n") > hot_rows, F.ceil(F.col("n") / hot_rows))
                          .otherwise(1).cast("int").alias("salts"))
    mine = flat.join(shared, "mh").groupBy("rid", "th").agg(
        F.collect_set(F.struct("mh", "s", "r", "salts")).alias("runs"))
    mine = stored(mine, "shared-runs", free=True)
    carriers = stored(keyed.join(mine.hint("merge"), ["rid", "th"]), "carriers", free=True)
    total, salts = carriers.agg(F.sum(F.size("runs")), F.max(F.array_max("runs.salts"))).first()
    rows = carriers.mapInArrow(
        lambda batches: _packed_rows(batches, window),
        "mh long, salts int, salt int, rid long, th long, s int, packed binary")

    def count(group: pa.Table) -> pa.Table:
        """A bucket by stretches of minimisers, which share no window, so a few strings at a time."""
        group = group.sort_by("mh")
        mh = group.column("mh").to_numpy()
        ends = np.append(np.flatnonzero(mh[1:] != mh[:-1]) + 1, len(mh))
        out, low = [], 0
        for end in ends.tolist():
            if end - low >= PART_ROWS or end == len(mh):
                out.append(counted(group.slice(low, end - low)))
                low = end
        return pa.concat_tables(out)

    def counted(group):
        strings, code = distinct_strings(group)
        data, a, b, h, string_of = windows_of(strings, window)
        groups = window_groups(data, a, b, h)
        lo = least_of(code, group.column("rid").to_numpy(), len(strings))
        smallest = least_of(groups, lo[string_of], len(h))
        return removed_ranges(group, code, string_of, smallest[groups], window)

    buckets = max(1, int((total or 0) // bucket_rows))
    usual = (rows.where("salts = 1").withColumn("bucket", F.pmod("mh", F.lit(buckets)))
             .groupBy("bucket").applyInArrow(count, RANGES))
    if (salts or 1) == 1:
        return carriers, usual
    return carriers, usual.unionByName(_hot_ranges(rows.where("salts > 1"), window))


def _hot_ranges(hot, window):
    def spelt(group):
        """Windows of the distinct strings of a salted group with the smallest and largest ids."""
        strings, code = distinct_strings(group)
        data, a, b, h, string_of = windows_of(strings, window)
        groups = window_groups(data, a, b, h)
        rid = group.column("rid").to_numpy()
        lo = least_of(groups, least_of(code, rid, len(strings))[string_of], len(h))
        hi = least_of(groups, least_of(code, rid, len(strings), np.maximum, -NO_ID)[string_of],
                      len(h), np.maximum, -NO_ID)
        return code, string_of, data, a, b, h, groups, lo, hi

    def reduce(group: pa.Table) -> pa.Table:
        """Hash, smallest and largest id of the windows of a salted group, by range of the hash."""
        *_, h, groups, lo, hi = spelt(group)
        values, inverse = np.unique(h, return_inverse=True)
        lo = least_of(inverse, lo[groups], len(values))
        hi = least_of(inverse, hi[groups], len(values), np.maximum, -NO_ID)
        salts = group.column("salts")[0].as_py()
        part = (values % np.uint64(salts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        offsets = pa.array(np.searchsorted(part[order], np.arange(salts + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order]))
                 for x in (values.view(np.int64), lo, hi)]
        return pa.table([pa.array([group.column("mh")[0].as_py()] * salts),
                         pa.array(range(salts), pa.int32()), pa.array([salts] * salts, pa.int32()),
                         *lists], names=["mh", "part", "salts", "h", "lo", "hi"])

    def merge(group: pa.Table) -> pa.Table:
        h, lo, hi = (group.column(c).combine_chunks().flatten().to_numpy() for c in ("h", "lo", "hi"))
        values, inverse = np.unique(h, return_inverse=True)
        lo = least_of(inverse, lo, len(values))
        hi = least_of(inverse, hi, len(values), np.maximum, -NO_ID)
        return pa.table({"mh": group.column("mh")[:1], "salts": group.column("salts")[:1],
                         "h": pa.array([values[lo < hi]], pa.list_(pa.int64()))})

    def candidates(group: pa.Table, known: pa.Table) -> pa.Table:
        """The words of the windows whose hash occurs under two ids, once for the salted group."""
        if not group.num_rows:
            return pa.table({"mh": pa.array([], pa.int64()), "salt": pa.array([], pa.int32()),
                             "h": pa.array([], pa.int64()), "words": pa.array([], pa.binary()),
                             "lo": pa.array([], pa.int64())})
        _, _, data, a, b, h, groups, lo, _ = spelt(group)
        keys = known.column("h").combine_chunks().flatten().to_numpy()
        _, first = np.unique(groups, return_index=True)
        first = first[np.isin(h[first].view(np.int64), keys)]
        return pa.table({
            "mh": pa.array([group.column("mh")[0].as_py()] * len(first), pa.int64()),
            "salt": pa.array([group.column("salt")[0].as_py()] * len(first), pa.int32()),
            "h": pa.array(h[first].view(np.int64)), "words": binaries(data, a[first], b[first]),
            "lo": pa.array(lo[groups[first]])})

    def back(group: pa.Table, known: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("rid", "th", "start", "end")})
        code, string_of, data, a, b, _, groups, _, _ = spelt(group)
        found = dict(zip(known.column("words").to_pylist(), known.column("lo").to_pylist()))
        _, first, of = np.unique(groups, return_index=True, return_inverse=True)
        smallest = np.array([found.get(data[a[i]:b[i]].tobytes(), NO_ID) for i in first.tolist()],
                            np.int64)
        return removed_ranges(group, code, string_of, smallest[of], window)

    lists = "mh long, part int, salts int, h array<long>, lo array<long>, hi array<long>"
    merged = hot.groupBy("mh", "salt").applyInArrow(reduce, lists).groupBy("mh", "part").applyInArrow(
        merge, "mh long, salts int, h array<long>")
    everywhere = merged.where(F.size("h") > 0).select(
        "mh", "h", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    asked = stored(hot.groupBy("mh", "salt").cogroup(everywhere.groupBy("mh", "salt")).applyInArrow(
        candidates, "mh long, salt int, h long, words binary, lo long"), "hot-windows", free=True)
    exact = asked.groupBy("mh", "h", "words").agg(F.min("lo").alias("lo"))
    known = asked.drop("lo").join(exact, ["mh", "h", "words"]).select("mh", "salt", "words", "lo")
    return hot.groupBy("mh", "salt").cogroup(known.groupBy("mh", "salt")).applyInArrow(back, RANGES)


def _packed_rows(batches, window):
    for batch in slices(batches):
        texts = texts_of(batch.column(batch.schema.get_field_index("text")))
        lists = batch.column(batch.schema.get_field_index("runs"))
        count = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        items = lists.flatten()
        mh, s, r, salts = (items.field(i).to_numpy() for i in range(4))
        own = np.repeat(np.arange(len(texts)), count)
        data, starts, ends, first = packed(texts)
        word = first[own] + s
        rid, th = (batch.column(batch.schema.get_field_index(c)).to_numpy()[own]
                   for c in ("rid", "th"))
        salt = mixed(rid.view(np.uint64) ^ th.view(np.uint64) ^ s.astype(np.uint64)) % salts.astype(
            np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(mh), pa.array(salts), pa.array(salt.astype(np.int32)), pa.array(rid),
             pa.array(th), pa.array(s),
             binaries(data, starts[word], ends[word + r + window - 2])],
            names=["mh", "salts", "salt", "rid", "th", "s", "packed"])


def spans_by_document(ranges):
    return stored(ranges.groupBy("rid", "th").agg(
        F.collect_set(F.struct("start", "end")).alias("gone")), "spans", free=True).hint("merge")


def without(texts, lists):
    """(kept text, number of words, number removed) per text; no range keeps the text as it is."""
    data, starts, ends, first = packed(texts)
    n_words = np.diff(first)
    count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    items = lists.flatten()
    own = np.repeat(np.arange(len(texts)), count)
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, first[own] + items.field(0).to_numpy(), 1)
    np.add.at(change, first[own] + items.field(1).to_numpy(), -1)
    kept = np.cumsum(change[:-1]) == 0
    out, removed = [], np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        if not count[i]:
            out.append(None)
            continue
        mine = np.flatnonzero(kept[first[i]:first[i + 1]]) + first[i]
        removed[i] = n_words[i] - len(mine)
        out.append(data[spread(starts[mine], ends[mine] - starts[mine] + 1)].tobytes()[:-1]
                   if len(mine) else b"")
    return out, n_words, removed


def clean(marked: DataFrame, text="text", gone="gone") -> DataFrame:
    """Cut the word ranges in ``gone`` from ``text``; adds ``n_words`` and ``n_removed``."""
    schema = with_fields(T.StructType([f for f in marked.schema.fields if f.name != gone]),
                         n_words=T.LongType(), n_removed=T.LongType())

    def run(batches):
        for batch in slices(batches, text):
            at, spans = (batch.schema.get_field_index(c) for c in (text, gone))
            column = batch.column(at)
            out, n_words, removed = without(texts_of(column), batch.column(spans))
            changed = pa.array([o is not None for o in out])
            new = pa.array(out, pa.binary()).cast(pa.string())
            column = pa.compute.if_else(changed, new, column.cast(pa.string()))
            batch = batch.set_column(at, pa.field(text, pa.string()), column)
            yield appended(batch.select([i for i in range(batch.num_columns) if i != spans]),
                           {"n_words": pa.array(n_words), "n_removed": pa.array(removed)})

    return marked.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, doc_id="doc_id", text="text", **sizes) -> DataFrame:
    """Documents without their repeated passages, with ``n_words`` and ``n_removed``."""
    keyed = _keyed(docs, doc_id, text)
    runs = stored(minimiser_runs(keyed), "runs").select("rid", "th", "runs")
    _, ranges = repeats(keyed, runs, **sizes)
    spans = spans_by_document(ranges).select(
        F.col("rid").alias("own_rid"), F.col("th").alias("own_th"), "gone")
    named = docs.drop("gone")
    marked = named.join(spans, (F.coalesce(named[doc_id].cast("long"), F.lit(NO_ID)) == spans.own_rid)
                        & (F.xxhash64(named[text]) == spans.own_th), "left").drop("own_rid", "own_th")
    return clean(marked, text)


def digests(docs: DataFrame, doc_id="doc_id", text="text", **sizes) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per document; only carriers' texts move twice."""
    keyed = _keyed(docs, doc_id, text)
    runs = stored(minimiser_runs(keyed), "runs")
    carriers, ranges = repeats(keyed, runs.select("rid", "th", "runs"), **sizes)
    carriers = carriers.drop("runs").distinct()
    cut = clean(carriers.join(spans_by_document(ranges), ["rid", "th"])).select(
        "rid", "th", "n_removed", F.sha2("text", 256).alias("own_sha"))
    return runs.drop("runs").join(cut, ["rid", "th"], "left").select(
        F.when(F.col("rid") != NO_ID, F.col("rid")).alias("doc_id"), "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("own_sha", "kept_sha256").alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
earliest AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, p FROM win JOIN earliest USING (h), unnest(range(i, i + 50)) AS t(p)
  WHERE lo < doc_id),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS s
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(cut.n, 0) AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)"""
