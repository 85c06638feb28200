"""Route network and centrality as iterative DataFrame jobs.

An edge list is (src, dest, weight) with one row per route. Iterations cut
their lineage with reliable checkpoints; the driver sees only one-row totals
that decide when to stop.
"""

import math
from functools import reduce
from typing import Optional, Tuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from delaylens.operators import brandes
from delaylens.session import cut, discard, freed_shuffles, scratch, stored

DAMPING = 0.85
#: Bytes of sketches that are shuffled along routes at a time, before compression.
TRANSIT_BYTES = 4 << 30
#: Largest number of routes that a task may hold whole (8 or 16 bytes each, and again while sorted).
WHOLE_ROUTES = 10_000_000


def network(flights: DataFrame, origin="origin", dest="dest") -> DataFrame:
    """Edge list weighted by the number of flights."""
    return flights.groupBy(F.col(origin).alias("src"), F.col(dest).alias("dest")).agg(
        F.count(F.lit(1)).alias("weight"))


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dest")).alias("airport")).distinct()


def network_summary(edges: DataFrame) -> DataFrame:
    """Nodes, edges, flights, mean flights per route and density."""
    n_nodes = nodes(edges).agg(F.count(F.lit(1))).scalar()
    totals = edges.agg(F.count(F.lit(1)).alias("edges"), F.sum("weight").alias("flights"),
                       F.avg("weight").alias("flights_per_route"))
    return totals.select(n_nodes.alias("nodes"), "*").withColumn(
        "density", F.coalesce(
            F.try_divide("edges", F.col("nodes") * (F.col("nodes") - 1)), F.lit(0.0)))


def _both_ends(edges, out, into):
    """One row per edge end: the airport with an outgoing and an incoming amount."""
    zero = F.lit(0).cast("long")
    return edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("airport"), out.alias("o"), zero.alias("i")),
        F.struct(F.col("dest").alias("airport"), zero.alias("o"), into.alias("i")))))


def degree(edges: DataFrame) -> DataFrame:
    """Routes in and out of each airport, and their share of the other airports."""
    one = F.lit(1).cast("long")
    counted = (_both_ends(edges, one, one).groupBy("airport")
               .agg(F.sum(F.col("o") + F.col("i")).alias("degree")))
    n = nodes(edges).agg(F.count(F.lit(1))).scalar()
    return counted.withColumn(
        "degree_centrality", F.coalesce(F.try_divide(F.col("degree"), n - 1), F.lit(1.0)))


def strength(edges: DataFrame) -> DataFrame:
    """Departures, arrivals and their sum per airport."""
    w = F.col("weight").cast("long")
    return (_both_ends(edges, w, w).groupBy("airport")
            .agg(F.sum("o").alias("total_departures"), F.sum("i").alias("total_arrivals"))
            .withColumn("total_flights", F.col("total_departures") + F.col("total_arrivals")))


def degree_distribution(edges: DataFrame) -> DataFrame:
    return degree(edges).groupBy("degree").agg(F.count(F.lit(1)).alias("airports"))


def subgraph(edges: DataFrame, airports: DataFrame) -> DataFrame:
    """Routes among the given airports; width is the weight relative to the largest."""
    kept = airports.select("airport").distinct()
    inner = (edges.join(kept.withColumnRenamed("airport", "src"), "src", "left_semi")
             .join(kept.withColumnRenamed("airport", "dest"), "dest", "left_semi"))
    return inner.withColumn("width", F.col("weight") / inner.agg(F.max("weight")).scalar())


# --- PageRank -----------------------------------------------------------------

def pagerank(edges: DataFrame, damping=DAMPING, tol=1e-6, max_iter=100) -> DataFrame:
    """Weighted PageRank by power iteration (Brin & Page, 1998).

    Starts uniform, spreads the rank of airports without departures evenly, and
    stops when the ranks of N airports change by less than N * tol in sum.
    """
    edges = cut(edges)
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    links = cut(edges.join(out, "src").select("src", "dest", (F.col("weight") / F.col("total"))
                                              .alias("share")))
    everyone = nodes(edges).join(out.select(F.col("src").alias("airport"), F.lit(False)
                                            .alias("stuck")), "airport", "left")
    everyone = cut(everyone.select("airport", F.coalesce("stuck", F.lit(True)).alias("stuck")))
    n, stuck = everyone.agg(F.count(F.lit(1)), F.count_if("stuck")).first()
    if n == 0:
        return everyone.select("airport", F.lit(0.0).alias("rank"))

    ranks = everyone.withColumn("rank", F.lit(1.0 / n))
    idle = stuck / n
    for _ in range(max_iter):
        given = (links.join(ranks, F.col("src") == F.col("airport"))
                 .groupBy("dest").agg(F.sum(F.col("rank") * F.col("share")).alias("got")))
        base = (1.0 - damping) / n + damping * idle / n
        moved = ranks.join(given, F.col("airport") == F.col("dest"), "left").select(
            "airport", "stuck", F.col("rank").alias("old"),
            (F.lit(base) + damping * F.coalesce("got", F.lit(0.0))).alias("rank"))
        moved = cut(moved)
        change, idle = moved.agg(
            F.sum(F.abs(F.col("rank") - F.col("old"))),
            F.coalesce(F.sum(F.when(F.col("stuck"), F.col("rank"))), F.lit(0.0))).first()
        ranks = moved.drop("old")
        if change < n * tol:
            return ranks.select("airport", F.col("rank").alias("pagerank"))
    raise RuntimeError(f"ranks still change after {max_iter} iterations")


# --- shortest paths -----------------------------------------------------------

def edge_cost(kind="weight") -> Column:
    """How long a route is: its flight count (the default), one hop, or 1 / flights."""
    return {"weight": F.col("weight"), "hops": F.lit(1).cast("long"),
            "inverse": 1.0 / F.col("weight")}[kind]


def pivots(edges: DataFrame, k=None) -> DataFrame:
    """All airports as path sources, or the k lowest by md5 of the code."""
    every = nodes(edges).select(F.col("airport").alias("source"))
    return every if k is None else every.orderBy(F.md5("source"), "source").limit(k)


def shortest_distances(edges: DataFrame, sources: DataFrame, cost="weight") -> DataFrame:
    """(source, airport, dist) for all reachable airports, by rounds of relaxation.

    A round extends only the pairs that improved in the round before.
    """
    hops = edges.where("src <> dest").select("src", "dest", edge_cost(cost).alias("cost"))
    zero = F.lit(0).cast(hops.schema["cost"].dataType)
    known = sources.select("source", F.col("source").alias("airport"), zero.alias("dist"),
                           F.lit(True).alias("fresh"))
    while True:
        tried = (known.where("fresh").join(hops, F.col("airport") == F.col("src"))
                 .groupBy("source", F.col("dest").alias("airport"))
                 .agg(F.min(F.col("dist") + F.col("cost")).alias("dist")))
        both = known.select("source", "airport", "dist", F.col("dist").alias("old")).unionByName(
            tried, allowMissingColumns=True)
        known = cut(both.groupBy("source", "airport")
                    .agg(F.min("dist").alias("dist"), F.min("old").alias("old"))
                    .select("source", "airport", "dist", (
                        F.col("old").isNull() | (F.col("dist") < F.col("old"))).alias("fresh")))
        if known.where("fresh").isEmpty():
            return known.drop("fresh")


def _spread(start, step):
    """Repeat ``step`` until it yields nothing; the list of all levels, start first."""
    levels = [start]
    while True:
        following = cut(step(levels[-1]))
        if following.isEmpty():
            return levels
        levels.append(following)


def _sum_levels(levels, out):
    return (reduce(DataFrame.unionByName, levels).groupBy("source", "airport")
            .agg(F.sum("x").alias(out)))


def dependencies(edges: DataFrame, sources: DataFrame, cost="weight") -> DataFrame:
    """(source, airport, x): how much the shortest paths from a source depend on each airport.

    Pair dependencies are accumulated per source along the shortest-path edges
    (Brandes, 2001), so the work is sources x routes and never all pairs of pairs.
    """
    hops = edges.where("src <> dest").select("src", "dest", edge_cost(cost).alias("cost"))
    dist = shortest_distances(edges, sources, cost)
    ahead = dist.select("source", F.col("airport").alias("dest"), F.col("dist").alias("reach"))
    tight = cut(
        dist.join(hops, F.col("airport") == F.col("src"))
        .withColumn("reach", F.col("dist") + F.col("cost"))
        .join(ahead, ["source", "dest", "reach"], "left_semi")
        .select("source", "src", "dest"))

    one = F.lit(1.0).alias("x")
    start = sources.select("source", F.col("source").alias("airport"), one)
    paths = cut(_sum_levels(_spread(start, lambda level: (
        level.withColumnRenamed("airport", "src").join(tight, ["source", "src"])
        .groupBy("source", F.col("dest").alias("airport")).agg(F.sum("x").alias("x")))), "paths"))

    near = paths.select("source", F.col("airport").alias("src"), F.col("paths").alias("near"))
    far = paths.select("source", F.col("airport").alias("dest"), F.col("paths").alias("far"))
    shares = cut(tight.join(near, ["source", "src"]).join(far, ["source", "dest"])
                 .select("source", "src", "dest", (F.col("near") / F.col("far")).alias("share")))

    ends = paths.where("airport <> source").select("source", "airport", one)
    levels = _spread(ends, lambda level: (
        level.withColumnRenamed("airport", "dest").join(shares, ["source", "dest"])
        .where("src <> source").groupBy("source", F.col("src").alias("airport"))
        .agg(F.sum(F.col("x") * F.col("share")).alias("x"))))
    through = levels[1:] or [ends.limit(0)]
    return reduce(DataFrame.unionByName, through)


def betweenness(edges: DataFrame, cost="weight", k=None) -> DataFrame:
    """Share of shortest paths through each airport, normalised (Freeman, 1977).

    With ``k`` only k pivots are sources and the sum is scaled by N / k
    (Brandes & Pich, 2007).
    """
    edges = cut(edges)
    sources = cut(pivots(edges, k))
    raw = dependencies(edges, sources, cost).groupBy("airport").agg(F.sum("x").alias("raw"))

    n = nodes(edges).agg(F.count(F.lit(1))).first()[0]
    used = sources.agg(F.count(F.lit(1))).first()[0]
    scale = (n / used) / ((n - 1) * (n - 2)) if n > 2 and used else 1.0
    return nodes(edges).join(raw, "airport", "left").select(
        "airport", (F.coalesce("raw", F.lit(0.0)) * scale).alias("betweenness"))


def _numbered(edges: DataFrame, ids: DataFrame, cost, most) -> Optional[Tuple[DataFrame, list]]:
    """Routes between numbered airports, packed, and the kinds of their numbers; None if tasks can't hold them."""
    hops = edges.where("src <> dest").select("src", "dest", edge_cost(cost).alias("cost"))
    routes, priced, low = hops.agg(F.count(F.lit(1)), F.count("cost"), F.min("cost")).first()
    kind = {"bigint": "i8", "int": "i8", "smallint": "i8", "tinyint": "i8", "double": "f8"}.get(
        hops.schema["cost"].dataType.simpleString())
    if kind is None or not 0 < routes == priced <= most or low <= 0:
        return None
    ends = [ids.select(F.col("source").alias(c), F.col("id").cast("int").alias(i))
            for c, i in (("src", "a"), ("dest", "b"))]
    ahead = hops.join(ends[0], "src").join(ends[1], "dest")
    if cost == "hops":
        return brandes.packed(ahead.select("a", "b")), ["i4", "i4"]
    exact = F.col("cost").cast("long") if kind == "i8" else F.col("cost")
    return brandes.packed(ahead.select("a", "b", exact.alias("cost"))), ["i4", "i4", kind]


def betweenness_within(edges: DataFrame, error=0.05, doubt=0.05, cost="weight", batch=32,
                       whole_routes=WHOLE_ROUTES) -> DataFrame:
    """Betweenness from as few sources as an error bound asks for: ``betweenness, bound, sources``.

    Sources are taken in batches, in the order of ``pivots``. After each batch every airport has a
    bound on its error, the better of one from the spread of what its sources gave (empirical
    Bernstein; Audibert, Munos & Szepesvari, 2007) and one that shrinks as sources run out (Serfling,
    1974). Sampling stops when all bounds are at most ``error``; all of them hold together, at all
    batches, with a probability of 1 - ``doubt`` over the order of sources. With every source used
    the result is exact and the bound 0. The driver sees one row per batch.

    Up to ``whole_routes`` routes the sources of a batch are dealt to tasks that hold the network; beyond,
    all sources go over the routes together, by joins. Both ways give the same up to rounding.
    """
    edges = cut(edges)
    order = F.row_number().over(W.orderBy(F.md5("source"), "source"))
    ranked = cut(pivots(edges).withColumn("at", order))  # one row per airport
    n = ranked.count()
    if n < 3:
        return nodes(edges).select("airport", F.lit(0.0).alias("betweenness"), F.lit(0.0).alias("bound"),
                                   F.lit(n).alias("sources"))
    ids = ranked.select("source", (F.col("at") - 1).alias("id"))
    whole = _numbered(edges, ids, cost, whole_routes)
    sums = nodes(edges).select("airport", F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    used = step = 0
    while True:
        step += 1
        begin, used = used, min(n, used + batch)
        if whole:
            new = brandes.summed(whole[0], n, whole[1], range(begin, used)).join(ids, "id").select(
                F.col("source").alias("airport"), "s", "q")
        else:
            part = cut(ranked.where((F.col("at") > begin) & (F.col("at") <= used)).select("source"))
            share = dependencies(edges, part, cost).groupBy("source", "airport").agg(
                (F.sum("x") / (n - 2)).alias("y"))
            new = share.groupBy("airport").agg(F.sum("y").alias("s"), F.sum(F.col("y") ** 2).alias("q"))
        sums = cut(sums.unionByName(new).groupBy("airport").agg(F.sum("s").alias("s"),
                                                                F.sum("q").alias("q")))
        # a share of the doubt for every airport, batch and kind of bound
        part_of_doubt = doubt / (2 * n * step * (step + 1))
        spread = F.greatest(F.col("q") / used - (F.col("s") / used) ** 2, F.lit(0.0))
        by_spread = (F.sqrt(2 * spread * math.log(3 / part_of_doubt) / used)
                     + 3 * math.log(3 / part_of_doubt) / used)
        by_size = math.sqrt((1 - (used - 1) / n) * math.log(2 / part_of_doubt) / (2 * used))
        to_scale = n / (n - 1)  # a source is no path end for itself
        bound = F.least(by_spread, F.lit(by_size)) * to_scale if used < n else F.lit(0.0)
        rows = sums.select("airport", (F.col("s") / used * to_scale).alias("betweenness"),
                           bound.alias("bound"), F.lit(used).alias("sources"))
        if used == n or rows.agg(F.max("bound")).first()[0] <= error:
            return rows


def closeness(edges: DataFrame) -> DataFrame:
    """Closeness over incoming hop distances, scaled by the share of airports that
    can reach the airport (Wasserman & Faust, 1994)."""
    edges = cut(edges)
    dist = shortest_distances(edges, pivots(edges), "hops")
    n = nodes(edges).agg(F.count(F.lit(1))).first()[0]
    reach = dist.groupBy("airport").agg(
        (F.count(F.lit(1)) - 1).alias("others"), F.sum("dist").alias("total"))
    value = F.try_divide(F.col("others") * F.col("others"), F.col("total") * (n - 1))
    return reach.select("airport", F.coalesce(value, F.lit(0.0)).alias("closeness_centrality"))


def closeness_by_sketches(edges: DataFrame, lg_k=12, max_rounds=None, transit=TRANSIT_BYTES) -> DataFrame:
    """Closeness from distinct-count sketches, in space that does not grow with the reach.

    Each airport keeps one sketch of the airports that can come to it within r hops. A round unites
    the sketches of its neighbours (Boldi & Vigna, 2013), so work is rounds x routes where exact
    distances need airports x routes. The sum of distances follows from the counts of all rounds.
    A sketch has at most about 2**lg_k bytes; the relative standard error of a count is near
    1.04 / sqrt(2**lg_k), and counts well below 2**lg_k / 8 are practically exact.

    A round takes the airports in as many parts as keep the sketches sent to one part within
    ``transit`` bytes; the shuffle files of a part go before the next, and the sketches of a round
    once the following round has its own. So the disk holds two sketches per airport and ``transit``.
    """
    spark = edges.sparkSession
    edges = stored(edges.where("src <> dest").select("src", "dest").distinct(), "routes", free=True)
    n = nodes(edges).agg(F.count(F.lit(1))).first()[0]
    parts = math.ceil(edges.count() * 2 ** lg_k / transit) or 1
    kept, state = None, nodes(edges).groupBy("airport").agg(
        F.hll_sketch_agg("airport", lg_k).alias("ball"), F.lit(1).cast("long").alias("reach"),
        F.lit(0).cast("long").alias("inner"))
    state = stored(state, "sketches", free=True)
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        folder, balls = scratch(spark, "sketches"), state.select(F.col("airport").alias("src"), "ball")
        for part in range(parts):
            here = F.pmod(F.xxhash64("airport"), F.lit(parts)) == part
            given = edges.withColumnRenamed("dest", "airport").where(here).join(balls, "src").drop("src")
            united = state.where(here).unionByName(given, allowMissingColumns=True).groupBy("airport").agg(
                F.hll_union_agg("ball").alias("grown"), F.max("reach").alias("reach"),
                F.max("inner").alias("inner"))
            with freed_shuffles(spark):
                united.select(
                    "airport", F.col("grown").alias("ball"),
                    # counts of a growing set are kept from falling
                    F.greatest(F.hll_sketch_estimate("grown"), "reach").alias("reach"),
                    (F.col("inner") + F.col("reach")).alias("inner"),
                    (F.hll_sketch_estimate("grown") > F.col("reach")).alias("moved")
                ).write.parquet(f"{folder}/{part}")
        following = spark.read.parquet(*[f"{folder}/{part}" for part in range(parts)])
        if following.where("moved").isEmpty():
            discard(spark, folder)
            break
        rounds += 1
        if kept:
            discard(spark, kept)
        kept, state = folder, following.drop("moved")
    # with N_r airports within r hops, distances sum to the sum of N - N_r over all rounds before
    others = F.col("reach") - 1
    total = rounds * F.col("reach") - F.col("inner")
    value = F.try_divide(others * others, total * (n - 1))
    return state.select("airport", F.coalesce(value, F.lit(0.0)).alias("closeness_centrality"))


def centrality(edges: DataFrame, cost="weight", tol=1e-6) -> DataFrame:
    """The eight-column centrality table of the network study."""
    edges = cut(edges)
    between = betweenness(edges, cost).withColumnRenamed("betweenness", "betweenness_centrality")
    return (
        degree(edges).select("airport", "degree_centrality")
        .join(between, "airport").join(closeness(edges), "airport")
        .join(pagerank(edges, tol=tol), "airport").join(strength(edges), "airport")
        .orderBy(F.desc("pagerank"), "airport"))


def centrality_scores(edges: DataFrame, k=100) -> DataFrame:
    """The three-column table used for scoring: PageRank and sampled betweenness."""
    edges = cut(edges)
    return pagerank(edges).join(betweenness(edges, "weight", k), "airport")
