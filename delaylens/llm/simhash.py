"""SimHash fingerprints and exact groups of near duplicates through vantage-point trees.

``fingerprints`` adds the 64-bit fingerprint of word shingles. ``components`` links fingerprints
that differ in at most ``max_bits`` bits and returns the smallest linked id for every document:

1. Equal fingerprints become one row, so exact copies cost nothing later.
2. A vantage-point tree, grown on a bounded sample, deals fingerprints to shards: each node holds a
   pivot and a median distance; a fingerprint goes to the near or the far side. By the triangle
   inequality, two within ``max_bits`` on different sides both lie within ``max_bits`` of the border,
   so far fingerprints that close are also sent to the near side as guests. No pair is lost.
3. Each shard searches its own pairs with the same pruning and returns one link per fingerprint, to
   the root of its component in the shard, never all pairs of a group.
4. Links of all shards are merged by propagating minima and jumping along them.

A shard that pivots cannot split (a ball of near copies) is searched through shared one-bit
neighbours in linear space; above ``dense_rows`` fingerprints those neighbours are grouped by Spark.

Null and empty texts have fingerprint zero and are linked like others. Documents with a null id get
their group's smallest other id, or null if there is none.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.llm.common import appended, cut, free_name, stored, with_fields
from delaylens.llm.kernels import slices, texts_of

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Fingerprints sampled for the tree, aimed at per shard, and searched at once inside a shard.
SAMPLE_ROWS = 20_000
SHARD_ROWS = 20_000
BLOCK_ROWS = 512
DENSE_ROWS = 500_000
MAX_DEPTH = 14
#: A split must leave each side at most this share of the rows, guests included.
PROGRESS = 0.9


# --- fingerprints -------------------------------------------------------------------

def fingerprints_of(texts, size=SHINGLE, seed=SEED):
    """uint64 fingerprint of each text."""
    starts, ends, first = texts.words()
    data = texts.lowered().data
    out = np.zeros(len(texts), np.uint64)
    hash_of = xxhash.xxh64_intdigest
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if a == b:
            continue
        s, e = starts[a:b], ends[a:b]
        gaps = s[1:] - e[:-1]
        if len(gaps) and gaps.max() > 1 or (len(gaps) and (data[e[:-1]] != 32).any()):
            text = b" ".join(data[s[0]:e[-1]].tobytes().split())
            length = e - s
            e = np.cumsum(length + 1) - 1
            s = e - length
        else:
            text = data[s[0]:e[-1]].tobytes()
            s, e = s - s[0], e - s[0]
        if b - a < size:
            hashes = [hash_of(text, seed)]
        else:
            hashes = [hash_of(text[x:y], seed)
                      for x, y in zip(s[:b - a - size + 1].tolist(), e[size - 1:].tolist())]
        out[i] = majority(np.array(hashes, np.uint64))
    return out


def majority(hashes):
    """Bits that are set in more than half of the values."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, text="text", out="fp", keep_text=False, size=SHINGLE) -> DataFrame:
    """Add ``out``, the fingerprint as a signed 64-bit integer."""
    base = docs.schema if keep_text else T.StructType(
        [f for f in docs.schema.fields if f.name != text])

    def run(batches):
        for batch in slices(batches, text):
            at = batch.schema.get_field_index(text)
            fp = fingerprints_of(texts_of(batch.column(at)), size).view(np.int64)
            own = batch if keep_text else batch.select(
                [i for i in range(batch.num_columns) if i != at])
            yield appended(own, {out: pa.array(fp)})

    return docs.mapInArrow(run, with_fields(base, **{out: T.LongType()}))


# --- trees ----------------------------------------------------------------------------

def distances(points, pivot):
    return np.bitwise_count(points ^ pivot).astype(np.int64)


def split(points, rng, bits):
    """(pivot, border) of the best of a few pivots, or None if none makes progress."""
    best = None
    for pivot in points[rng.integers(0, len(points), 6)]:
        d = distances(points, pivot)
        border = int(np.median(d))
        near = int((d <= border + bits).sum())
        far = int((d > border).sum())
        if far and max(near, far) <= PROGRESS * len(points):
            cost = near + far
            if best is None or cost < best[0]:
                best = (cost, pivot, border)
    return best[1:] if best else None


def grow(sample, total, bits=MAX_BITS, shard_rows=SHARD_ROWS, seed=11):
    """Tree as a list of nodes (pivot, border, near child, far child); leaves are (rows,)."""
    rng = np.random.default_rng(seed)
    scale = total / max(1, len(sample))
    nodes = [None]
    todo = [(0, sample, 0)]
    while todo:
        at, points, depth = todo.pop()
        cut_at = None
        if len(points) * scale > shard_rows and depth < MAX_DEPTH and len(points) > 8:
            cut_at = split(points, rng, bits)
        if cut_at is None:
            nodes[at] = (len(points) * scale,)
            continue
        pivot, border = cut_at
        d = distances(points, pivot)
        nodes[at] = (pivot, border, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), points[d <= border + bits], depth + 1),
                 (len(nodes) + 1, points[d > border], depth + 1)]
        nodes += [None, None]
    return nodes


def route(nodes, points, bits=MAX_BITS):
    """(index of the point, leaf) of every shard that must see each point."""
    rows, leaves = [], []
    todo = [(0, np.arange(len(points)))]
    while todo:
        at, which = todo.pop()
        node = nodes[at]
        if not len(which):
            continue
        if len(node) == 1:
            rows.append(which)
            leaves.append(np.full(len(which), at, np.int32))
            continue
        d = distances(points[which], node[0])
        todo += [(node[2], which[d <= node[1] + bits]), (node[3], which[d > node[1]])]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(leaves)


class Union:
    """Union-find over positions with vectorised flattening."""

    def __init__(self, n):
        self.up = np.arange(n)

    def root(self, i):
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def link(self, a, b):
        """Join many pairs: repeatedly hang the larger root below the smaller."""
        a, b = np.asarray(a), np.asarray(b)
        while len(a):
            self.flatten()
            a, b = self.up[a], self.up[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))

    def flatten(self):
        while True:
            nxt = self.up[self.up]
            if (nxt == self.up).all():
                return
            self.up = nxt


def link_near(points, which, found, bits, rng):
    """Link all pairs of ``points[which]`` within ``bits``; ``found`` is a Union over points."""
    todo = [which]
    while todo:
        which = todo.pop()
        if len(which) < 2:
            continue
        if len(which) <= BLOCK_ROWS:
            part = points[which]
            a, b = np.nonzero(np.bitwise_count(part[:, None] ^ part[None, :]) <= bits)
            up = a < b
            found.link(which[a[up]], which[b[up]])
            continue
        cut_at = split(points[which], rng, bits)
        if cut_at is None and bits % 2 == 0:
            link_dense(points, which, found, bits)
            continue
        if cut_at is None:
            for at in range(0, len(which), BLOCK_ROWS):
                rows = points[which[at:at + BLOCK_ROWS]]
                a, b = np.nonzero(np.bitwise_count(rows[:, None] ^ points[which][None]) <= bits)
                found.link(which[a + at], which[b])
            continue
        d = distances(points[which], cut_at[0])
        todo += [which[d <= cut_at[1] + bits], which[d > cut_at[1]]]


def flips(bits):
    """Masks whose pairwise differences reach every change of at most ``bits`` bits."""
    masks, have = [0], {0}
    for _ in range((bits + 1) // 2):
        have |= {m ^ (1 << i) for m in have for i in range(64)}
    return np.array(sorted(have | set(masks)), np.uint64)


def link_dense(points, which, found, bits):
    """Two within ``2k`` bits share a neighbour within ``k`` bits: link all that share one.

    Exact for an even number of bits. Only a 64th of the neighbours is held at a time.
    """
    part = points[which]
    masks = flips(bits)
    parts = 64 if len(part) > 50_000 else 1
    for k in range(parts):
        keys, owners = [], []
        for m in masks:
            key = part ^ m
            own = (np.flatnonzero((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58) == k)
                   if parts > 1 else np.arange(len(part)))
            keys.append(key[own])
            owners.append(own)
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        keys, owners = keys[order], owners[order]
        same = np.flatnonzero(keys[1:] == keys[:-1])
        a, b = owners[same], owners[same + 1]
        found.link(which[a], which[b])


def shard_links(points, bits=MAX_BITS, seed=5):
    """(point, root) of every distinct point that is linked to another one of the shard."""
    points = np.unique(points)
    found = Union(len(points))
    link_near(points, np.arange(len(points)), found, bits, np.random.default_rng(seed))
    found.flatten()
    moved = found.up != np.arange(len(points))
    return points[moved], points[found.up[moved]]


# --- Spark ------------------------------------------------------------------------------

def links(distinct: DataFrame, total, bits=MAX_BITS, sample_rows=SAMPLE_ROWS,
          shard_rows=SHARD_ROWS, dense_rows=DENSE_ROWS) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within ``bits`` bits; ``distinct(fp)``."""
    if bits % 2:
        dense_rows = float("inf")
    sample = distinct.orderBy(F.xxhash64("fp")).limit(sample_rows).toArrow()
    sample = sample.column("fp").to_numpy().view(np.uint64)
    nodes = grow(sample, total, bits, shard_rows)
    dense = [i for i, n in enumerate(nodes) if len(n) == 1 and n[0] > dense_rows]

    def deal(batches):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows, leaves = route(nodes, points, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(points[rows].view(np.int64)), pa.array(leaves)], names=["fp", "shard"])

    dealt = distinct.select("fp").mapInArrow(deal, "fp long, shard int")

    def search(group: pa.Table) -> pa.Table:
        points = group.column("fp").to_numpy().view(np.uint64)
        a, b = shard_links(points, bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    usual = dealt.where(~F.col("shard").isin(dense)) if dense else dealt
    out = usual.groupBy("shard").applyInArrow(search, "a long, b long")
    if dense:
        masks = F.array(*[F.lit(int(m) - (1 << 64) if m >> np.uint64(63) else int(m))
                          for m in flips(bits)])
        near = dealt.where(F.col("shard").isin(dense)).withColumn("mask", F.explode(masks))
        shared = near.groupBy("shard", F.col("fp").bitwiseXOR(F.col("mask")).alias("key")).agg(
            F.min("fp").alias("b"))
        out = out.unionByName(near.select(
            "shard", F.col("fp").bitwiseXOR(F.col("mask")).alias("key"), F.col("fp").alias("a"))
            .join(shared, ["shard", "key"]).where("a <> b").select("a", "b"))
    return out


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node reached."""
    edges = stored(edges.union(edges.select("b", "a")).distinct(), "links")
    roots = stored(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    while True:
        seen = edges.join(roots, edges.b == roots.node).groupBy("a").agg(F.min("root").alias("seen"))
        low = roots.join(seen, roots.node == seen.a).select(
            "node", F.col("root").alias("was"), F.least("root", "seen").alias("low"))
        # a smaller root found by any node is handed to the root it had, then one jump is taken
        handed = low.groupBy(F.col("was").alias("node")).agg(F.min("low").alias("handed"))
        step = low.join(handed, "node", "left").select(
            "node", "was", F.least("low", "handed").alias("low"))
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("next"))
        after = cut(step.join(jump, "low").select(
            "node", "was", F.least("low", "next").alias("root")))
        moved = after.where("root <> was").limit(1).count()
        roots = after.select("node", "root")
        if not moved:
            return roots


def components(marked: DataFrame, doc_id="doc_id", fp="fp", bits=MAX_BITS, **sizes) -> DataFrame:
    """Add ``component_id`` and ``component_root`` (a fingerprint, never null) to marked rows."""
    marked = stored(marked.drop("component_id", "component_root", "own_fp"), "fingerprints")
    distinct = stored(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first_id")),
                      "distinct")
    total = distinct.count()
    roots = connected(links(distinct, total, bits, **sizes))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("component_root"))
    smallest = placed.groupBy("component_root").agg(F.min("first_id").alias("component_id"))
    by_fp = placed.join(smallest, "component_root").select(
        F.col("fp").alias("own_fp"), "component_id", "component_root")
    return marked.join(by_fp, marked[fp] == by_fp.own_fp).drop("own_fp")


def keep_one(docs: DataFrame, doc_id="doc_id", text="text", bits=MAX_BITS, size=SHINGLE,
             **sizes) -> DataFrame:
    """One document of each group: that of the smallest id (missing ids last), once if repeated."""
    rid, th = free_name(docs, "rid"), free_name(docs, "th")
    keyed = docs.withColumns({rid: F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)),
                              th: F.xxhash64(text)})
    marked = fingerprints(keyed.select(F.col(rid).alias("rid"), F.col(th).alias("th"),
                                       F.col(text).alias("text")), size=size)
    first = components(marked, "rid", bits=bits, **sizes).groupBy("component_root").agg(
        F.min(F.struct("rid", "th")).alias("one"))
    ones = first.select(F.col("one.rid").alias(rid), F.col("one.th").alias(th))
    return keyed.join(ones, [rid, th]).dropDuplicates([rid, th]).drop(rid, th)
