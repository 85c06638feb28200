"""Exact k-means on integer vectors, with bounds that follow total displacements (ns-bounds).

Every vector keeps, for each centroid, its distance when that was last computed and the round of it.
The centroids of all rounds are kept (k x rounds of them, small), so after any number of rounds the
old distance is loosened by one number, the norm of the centroid's *total* displacement since that
round: the norm of a sum, never more than the sum of norms that per-round drifts would add up. A
centroid whose lower bound stays above the upper bound of the vector's own one cannot be nearest; all
others are computed again, exactly, as integers. Bounds are floats and are widened by a relative
``SLACK``, and only a strict gap rules a centroid out, so ties (smaller number wins) are exact too.

Each round writes the table of vectors with their bounds to the shared folder and sums vectors by
cluster inside the tasks; the driver gets k exact sums. Results do not depend on partitions.

Vectors that are null, have another number of components, or a component that is null, not finite or
beyond ``LIMIT`` (whose squared distances would not fit 64 bits) take no part. A null id is hashed as
empty text; repeated ids and vectors are clustered row by row, equal hashes by their components.
With fewer vectors than clusters there are fewer clusters; an empty table gives an empty table.
Extra columns are not carried.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from delaylens.llm.common import stored

CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
#: Largest size of a scaled component.
LIMIT = 1 << 27
SLACK = 1e-9


def integers(vectors: DataFrame, vec_id="vec_id", embedding="embedding", dimensions=DIMENSIONS,
             scale=SCALE) -> DataFrame:
    """``vec_id, x``: the scaled, floored vectors that take part."""
    x = F.transform(F.col(embedding), lambda v: F.floor(v.cast("double") * scale).cast("long"))
    fits = F.forall(F.col(embedding), lambda v: F.coalesce(
        F.abs(v.cast("double") * scale) <= LIMIT, F.lit(False)) & ~F.isnan(v.cast("double")))
    whole = F.when(F.size(embedding) == dimensions, fits)
    return vectors.where(whole).select(F.col(vec_id).alias("vec_id"), x.alias("x"))


def first_centroids(rows: DataFrame, clusters=CLUSTERS, seed="1") -> np.ndarray:
    """The vectors with the smallest hashes of seed and id (at most ``clusters`` rows)."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))),
                  256)
    chosen = rows.orderBy(rank, "x").limit(clusters).select("x").collect()
    return np.array([r["x"] for r in chosen], np.int64)


def squared(x, centroid):
    """Exact squared distances of rows of ``x`` to one centroid, or to one each."""
    apart = x - centroid
    return np.einsum("ij,ij->i", apart, apart)


class History:
    """Centroids of every round so far."""

    def __init__(self, first):
        self.rounds = [first]

    def moved(self):
        """(round, centroid): norm of the displacement from that round to now."""
        now = self.rounds[-1]
        apart = np.stack([now - then for then in self.rounds]).astype(float)
        return np.sqrt((apart * apart).sum(2)) * (1 + SLACK)

    def assign(self, x, cluster, last, seen):
        """(cluster, distance, last distances, rounds they are of) with the newest centroids.

        ``last`` holds each vector's distance to each centroid in the round named by ``seen``.
        """
        now, n = len(self.rounds) - 1, len(x)
        centroids = self.rounds[-1]
        rows = np.arange(n)
        own = squared(x, centroids[cluster])
        last, seen = last.copy(), seen.copy()
        last[rows, cluster], seen[rows, cluster] = np.sqrt(own), now
        upper = np.sqrt(own) * (1 + SLACK)
        lower = last * (1 - SLACK) - self.moved()[seen, np.arange(len(centroids))]
        best, chosen = own, cluster.copy()
        for k, centroid in enumerate(centroids):
            near = np.flatnonzero((lower[:, k] <= upper) & (cluster != k))
            if not len(near):
                continue
            found = squared(x[near], centroid)
            last[near, k], seen[near, k] = np.sqrt(found), now
            closer = (found < best[near]) | ((found == best[near]) & (k < chosen[near]))
            best[near[closer]], chosen[near[closer]] = found[closer], k
        return chosen, best, last, seen

    def begin(self, x):
        """As ``assign``, for vectors without bounds."""
        found = np.stack([squared(x, c) for c in self.rounds[-1]], 1)
        chosen = found.argmin(1)
        return (chosen, found[np.arange(len(x)), chosen], np.sqrt(found),
                np.zeros(found.shape, np.int64))


def _matrix(column, dtype, width):
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, width)


def _lists(values, kind):
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(values.ravel(), kind))


def assigned(rows: DataFrame, history: History, label) -> DataFrame:
    """The table of vectors with cluster, distance and bounds, written once."""
    k, width = history.rounds[0].shape
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), np.int64, width)
            if batch.num_columns == 2:
                found = history.begin(x)
            else:
                found = history.assign(x, batch.column(2).to_numpy(), _matrix(
                    batch.column(4), float, k), _matrix(batch.column(5), np.int64, k))
            cluster, distance, last, seen = found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cluster), pa.array(distance),
                 _lists(last, pa.float64()), _lists(seen, pa.int16())],
                names=["vec_id", "x", "cluster", "distance", "last", "seen"])

    return stored(rows.mapInArrow(run, f"vec_id {kind}, x array<long>, cluster long, distance long, "
                                  "last array<double>, seen array<smallint>"), label)


def moved_centroids(table: DataFrame, centroids) -> np.ndarray:
    """Componentwise floor of the mean of each cluster's vectors; empty ones stay.

    A task gives out one sum per cluster and component, in 64 bits for as many rows as fit them;
    the totals are decimals.
    """
    k, width = centroids.shape
    most = (1 << 62) // LIMIT

    def run(batches):
        for batch in batches:
            x, of = _matrix(batch.column(0), np.int64, width), batch.column(1).to_numpy()
            for low in range(0, len(x), most):
                for c in np.unique(of[low:low + most]):
                    part = x[low:low + most][of[low:low + most] == c]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(width, c)), pa.array(np.arange(width)),
                         pa.array(part.sum(0)), pa.array(np.full(width, len(part)))],
                        names=["cluster", "at", "total", "n"])

    sums = table.select("x", "cluster").mapInArrow(
        run, "cluster long, at long, total long, n long").groupBy("cluster", "at").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in sums.collect():  # clusters x components
        moved[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return moved


def cluster(vectors: DataFrame, vec_id="vec_id", embedding="embedding", clusters=CLUSTERS,
            rounds=ROUNDS, dimensions=DIMENSIONS, scale=SCALE, seed="1") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector."""
    rows = integers(vectors, vec_id, embedding, dimensions, scale)
    first = first_centroids(rows, clusters, seed)
    if not len(first):
        return rows.select(
            F.col("vec_id").alias(vec_id), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c)
            for c in ("distance", "cluster_inertia", "inertia")], "x").withColumnRenamed("x", "centroid")
    history = History(first)
    table = assigned(rows, history, "ns-bounds-0")
    for k in range(rounds):
        history.rounds.append(moved_centroids(table, history.rounds[-1]))
        table = assigned(table, history, f"ns-bounds-{k + 1}")
    last = table.select("vec_id", "cluster", "distance")
    per_cluster = last.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    final = last.sparkSession.createDataFrame(
        [(k, [int(v) for v in c]) for k, c in enumerate(history.rounds[-1])],
        "cluster long, centroid array<long>")
    totals = per_cluster.select(  # one row per cluster
        "*", F.sum("cluster_inertia").over(W.partitionBy()).alias("inertia")).join(final, "cluster")
    # the joined side has one row per cluster, however large the input
    return last.join(F.broadcast(totals), "cluster").select(
        F.col("vec_id").alias(vec_id), F.col("cluster").cast("int").alias("cluster"), "distance",
        "cluster_inertia", "inertia", "centroid")


def digest(column):
    """sha256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(column, lambda v: v.cast("string")), ","), 256)


def _oracle():
    """The same rounds by definition, unrolled."""
    parts = [f"""
kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding,
    lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {DIMENSIONS}
    AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, x AS c
  FROM (SELECT * FROM kept ORDER BY sha256('1:' || vec_id) LIMIT {CLUSTERS}))"""]
    for k in range(ROUNDS + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT vec_id, x, cluster, CAST(list_sum(list_transform(range(1, {DIMENSIONS + 1}),
      lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d FROM kept, c{k}) GROUP BY ALL)""")
        if k < ROUNDS:
            parts.append(f"""
m{k} AS (SELECT cluster, i, CAST(floor(sum(v) / count(*)) AS BIGINT) AS v FROM (
    SELECT cluster, unnest(x) AS v, unnest(range({DIMENSIONS})) AS i FROM a{k}) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c{k}.cluster, coalesce(n.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
    SELECT cluster, list(v ORDER BY i) AS c FROM m{k} GROUP BY ALL) n ON n.cluster = c{k}.cluster)""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)"""


ORACLE = _oracle()
