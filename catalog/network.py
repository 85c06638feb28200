"""Route network, centrality and the airport tables built on it."""

from pyspark.sql import functions as F

from catalog import base
from catalog.base import query, with_tables
from catalog.reports import rounded
from delaylens.functions import columns as C
from delaylens.operators import filters, graph, joins, matrix, reports, reshape

# Shortest paths in SQL: min-plus doubling (2^5 hops), then all shortest paths.
# A path is a row; costs rise along it, so the recursion ends.


def _distances(prefix, cost):
    """CTEs d0..d5: cheapest walk of up to 2^i hops between nodes."""
    out = {f"{prefix}e": (["edges"], f"SELECT src, dest, CAST({cost} AS BIGINT) AS c FROM edges "
                                     "WHERE src <> dest"),
           f"{prefix}0": ([f"{prefix}e", "nodes"], f"""SELECT s, v, min(c) AS dist FROM (
               SELECT src AS s, dest AS v, c FROM {prefix}e
               UNION ALL SELECT airport, airport, 0 FROM nodes) GROUP BY 1, 2""")}
    for i in range(1, 6):
        last = f"{prefix}{i - 1}"
        out[f"{prefix}{i}"] = ([last], f"""SELECT a.s, b.v, min(a.dist + b.dist) AS dist
            FROM {last} a JOIN {last} b ON a.v = b.s GROUP BY 1, 2""")
    return out


NODES = {"nodes": (["edges"], "SELECT src AS airport FROM edges UNION SELECT dest FROM edges")}
SIZE = "(SELECT count(*) FROM nodes)"

PATHS = {
    "sp": (["w5", "we"], """SELECT s, s AS v, CAST(0 AS BIGINT) AS cost, [s] AS via
        FROM (SELECT DISTINCT s FROM w5)
        UNION ALL SELECT p.s, e.dest, p.cost + e.c, list_append(p.via, e.dest)
        FROM sp p JOIN we e ON p.v = e.src JOIN w5 d ON d.s = p.s AND d.v = e.dest
          AND d.dist = p.cost + e.c"""),
    "sigma": (["sp"], "SELECT s, v, count(*) AS paths FROM sp GROUP BY 1, 2"),
    "through": (["sp", "sigma"], """SELECT p.s, mid.x AS airport,
          sum(1.0::DOUBLE / g.paths) AS part
        FROM sp p JOIN sigma g ON p.s = g.s AND p.v = g.v,
          unnest(p.via[2:-2]) AS mid(x) WHERE p.v <> p.s GROUP BY 1, 2"""),
}


def _between(pivots=None):
    n = f"CAST({SIZE} AS DOUBLE)"
    if pivots is None:
        scale, source = f"1 / (({n} - 1) * ({n} - 2))", ""
    else:
        scale = f"({n} / {pivots}) / (({n} - 1) * ({n} - 2))"
        source = f"WHERE s IN (SELECT airport FROM nodes ORDER BY md5(airport), airport LIMIT {pivots})"
    return f"""SELECT airport, round(coalesce(b, 0) * {scale}, 9) AS betweenness FROM nodes
      LEFT JOIN (SELECT airport, sum(part) AS b FROM through {source} GROUP BY 1) t
      USING (airport)"""


RANK = {
    "outw": (["edges"], "SELECT src, sum(weight) AS total FROM edges GROUP BY 1"),
    "links": (["edges", "outw"], """SELECT src, dest, CAST(weight / total AS DOUBLE) AS share
        FROM edges JOIN outw USING (src)"""),
    "steps": (["links", "nodes"], f"""SELECT 0 AS step, airport,
          CAST(1.0 / {SIZE} AS DOUBLE) AS rank FROM nodes
        UNION ALL
        SELECT (SELECT max(step) FROM steps) + 1, n.airport,
          0.15::DOUBLE / {SIZE}
          + 0.85::DOUBLE * (SELECT coalesce(sum(rank), 0) FROM steps WHERE airport NOT IN
              (SELECT src FROM links)) / {SIZE}
          + 0.85::DOUBLE * coalesce((SELECT sum(s.rank * l.share) FROM steps s
              JOIN links l ON l.src = s.airport WHERE l.dest = n.airport), 0)
        FROM nodes n WHERE (SELECT max(step) FROM steps) < 40"""),
    "settled": (["steps"], f"""SELECT min(step) AS step FROM (
        SELECT b.step, sum(abs(a.rank - b.rank)) AS change FROM steps a
        JOIN steps b ON b.airport = a.airport AND b.step = a.step + 1 GROUP BY 1)
        WHERE change < {SIZE} * 1e-6::DOUBLE"""),
    "pr": (["settled"], """SELECT airport, rank AS pagerank FROM steps
        WHERE step = (SELECT step FROM settled)"""),
}

STRENGTH = {"strength": (["nodes", "edges"], """SELECT airport,
      coalesce((SELECT sum(weight) FROM edges WHERE src = airport), 0)::BIGINT AS total_departures,
      coalesce((SELECT sum(weight) FROM edges WHERE dest = airport), 0)::BIGINT AS total_arrivals
    FROM nodes""")}

DEGREE = {"deg": (["nodes", "edges"], """SELECT airport,
      (SELECT count(*) FROM edges WHERE src = airport)
      + (SELECT count(*) FROM edges WHERE dest = airport) AS degree FROM nodes""")}

CLOSE = f"""SELECT n.airport, round(coalesce((r.k - 1) * (r.k - 1)
      / nullif(r.total * ({SIZE} - 1), 0), 0)::DOUBLE, 9) AS closeness_centrality
    FROM nodes n LEFT JOIN (SELECT v, count(*) AS k, sum(dist)::DOUBLE AS total FROM h5 GROUP BY 1) r
      ON r.v = n.airport"""


edges = base.edges


@query("route_counts", with_tables("routes", body="SELECT * FROM routes"))
def route_counts(spark, sf):
    return graph.network(base.legs(spark, sf))


@query("operated_route_counts", with_tables("ontime", body="""
SELECT origin AS src, dest, count(*) AS weight FROM ontime WHERE cancelled = 0 GROUP BY ALL"""))
def operated_route_counts(spark, sf):
    return graph.network(base.ontime(spark, sf).where("cancelled = 0"))


@query("network_summary", with_tables("routes", body=f"""
SELECT n.k AS nodes, count(*) AS edges, CAST(sum(weight) AS BIGINT) AS flights,
  round(avg(weight), 9) AS flights_per_route, round(count(*) / (n.k * (n.k - 1)), 9) AS density
FROM routes, (SELECT count(*) AS k FROM (SELECT src FROM routes UNION SELECT dest FROM routes)) n
GROUP BY n.k"""))
def network_summary(spark, sf):
    return rounded(graph.network_summary(graph.network(base.legs(spark, sf))),
                   "flights_per_route", "density")


@query("degree_centrality", with_tables("edges", extra={**NODES, **DEGREE}, body=f"""
SELECT airport, degree, round(degree / ({SIZE} - 1), 9) AS degree_centrality FROM deg"""))
def degree_centrality(spark, sf):
    return rounded(graph.degree(edges(spark, sf)), "degree_centrality")


@query("airport_strength", with_tables("edges", extra={**NODES, **STRENGTH}, body="""
SELECT *, total_departures + total_arrivals AS total_flights FROM strength"""))
def airport_strength(spark, sf):
    return graph.strength(edges(spark, sf))


@query("degree_distribution", with_tables("edges", extra={**NODES, **DEGREE}, body="""
SELECT degree, count(*) AS airports FROM deg GROUP BY 1"""))
def degree_distribution(spark, sf):
    return graph.degree_distribution(edges(spark, sf))


@query("degree_extremes", with_tables("edges", extra={**NODES, **DEGREE}, body="""
SELECT round(avg(degree), 9) AS mean_degree, max(degree) AS max_degree,
  (SELECT max(airport) FROM deg WHERE degree = (SELECT max(degree) FROM deg)) AS airport
FROM deg"""))
def degree_extremes(spark, sf):
    d = graph.degree(edges(spark, sf))
    return rounded(d.agg(F.avg("degree").alias("mean_degree"), F.max("degree").alias("max_degree"),
                         F.max_by("airport", F.struct("degree", "airport")).alias("airport")),
                   "mean_degree")


@query("pagerank", with_tables("edges", extra={**NODES, **RANK}, recursive=True, body="""
SELECT airport, round(pagerank, 9) AS pagerank FROM pr"""))
def pagerank(spark, sf):
    return rounded(graph.pagerank(edges(spark, sf)), "pagerank")


@query("betweenness", with_tables("edges", extra={**NODES, **_distances("w", "weight"), **PATHS},
                                  recursive=True, body=_between()))
def betweenness(spark, sf):
    return rounded(graph.betweenness(edges(spark, sf)), "betweenness")


@query("sampled_betweenness", with_tables(
    "edges", extra={**NODES, **_distances("w", "weight"), **PATHS}, recursive=True,
    body=_between(10)))
def sampled_betweenness(spark, sf):
    return rounded(graph.betweenness(edges(spark, sf), k=10), "betweenness")


@query("closeness", with_tables("edges", extra={**NODES, **_distances("h", "1")},
                                recursive=True, body=CLOSE))
def closeness(spark, sf):
    return rounded(graph.closeness(edges(spark, sf)), "closeness_centrality")


CENTRALITY = {
    **NODES, **DEGREE, **STRENGTH, **RANK, **_distances("w", "weight"), **_distances("h", "1"),
    **PATHS, "bt": (["nodes", "through"], _between()), "cl": (["nodes", "h5"], CLOSE),
    "central": (["deg", "bt", "cl", "pr", "strength"], f"""
      SELECT airport, degree / ({SIZE} - 1) AS degree_centrality,
        betweenness AS betweenness_centrality, closeness_centrality, pagerank, total_departures,
        total_arrivals, total_departures + total_arrivals AS total_flights
      FROM deg JOIN bt USING (airport) JOIN cl USING (airport) JOIN pr USING (airport)
        JOIN strength USING (airport)""")}


@query("centrality_table", with_tables("edges", extra=CENTRALITY, recursive=True, body="""
SELECT * REPLACE (round(degree_centrality, 9) AS degree_centrality, round(pagerank, 9) AS pagerank)
FROM central"""))
def centrality_table(spark, sf):
    return rounded(graph.centrality(edges(spark, sf)), "degree_centrality",
                   "betweenness_centrality", "closeness_centrality", "pagerank")


METRICS = ["degree_centrality", "betweenness_centrality", "closeness_centrality", "pagerank",
           "total_flights"]


@query("centrality_metric_correlation", with_tables("edges", extra=CENTRALITY, recursive=True,
       body=" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}::DOUBLE, {b}::DOUBLE), 5) AS corr FROM central"
    for a in METRICS for b in METRICS)))
def centrality_metric_correlation(spark, sf):
    return rounded(reports.corr_matrix(graph.centrality(edges(spark, sf)), METRICS), "corr",
                   digits=5)


CORR = ["total_departures", "total_arrivals", "degree"]


@query("centrality_correlation", with_tables("edges", extra={**NODES, **DEGREE, **STRENGTH},
                                             body=" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS corr "
    "FROM deg JOIN strength USING (airport)" for a in CORR for b in CORR)))
def centrality_correlation(spark, sf):
    e = edges(spark, sf)
    table = graph.degree(e).join(graph.strength(e), "airport")
    return rounded(reports.corr_matrix(table, CORR), "corr", digits=6)


@query("hub_subgraph", with_tables("edges", extra={**NODES, **RANK, "hubs": (["pr"], """
    SELECT airport FROM pr ORDER BY round(pagerank, 12) DESC, airport LIMIT 30""")},
    recursive=True, body="""
SELECT src, dest, weight, round(weight / max(weight) OVER (), 9) AS width FROM edges
WHERE src IN (SELECT airport FROM hubs) AND dest IN (SELECT airport FROM hubs)"""))
def hub_subgraph(spark, sf):
    e = edges(spark, sf)
    ranks = rounded(base.centrality(spark, sf), "pagerank", digits=12)
    best = reshape.top_k(ranks, "pagerank", 30, "airport")
    return rounded(graph.subgraph(e, best), "width")


# --- airport tables -----------------------------------------------------------------

hubs = base.centrality
HUBS = {**NODES, **RANK, **_distances("w", "weight"), **PATHS, "bt": (["nodes", "through"], _between()),
        "hubs": (["pr", "bt"], "SELECT airport, pagerank, betweenness FROM pr JOIN bt USING (airport)")}


@query("flights_with_centrality", with_tables("scores", recursive=True, extra={**HUBS, "big": (["hubs"], """
  SELECT * FROM hubs WHERE pagerank >= (SELECT avg(pagerank) FROM hubs)""")}, body="""
SELECT flight_number, round(coalesce(o.pagerank, 0), 9) AS origin_pagerank,
  round(coalesce(o.betweenness, 0), 9) AS origin_betweenness,
  round(coalesce(d.pagerank, 0), 9) AS dest_pagerank,
  round(coalesce(d.betweenness, 0), 9) AS dest_betweenness
FROM scores s LEFT JOIN big o ON s."Origin" = o.airport LEFT JOIN big d ON s."Dest" = d.airport"""))
def flights_with_centrality(spark, sf):
    every = hubs(spark, sf)
    known = every.where(F.col("pagerank") >= every.agg(F.avg("pagerank")).scalar())
    out = joins.add_centrality(base.scores(spark, sf), known)
    names = ["origin_pagerank", "origin_betweenness", "dest_pagerank", "dest_betweenness"]
    return rounded(out.select("flight_number", *names), *names)


RATES = {"rates": (["scores"], """SELECT "Origin" AS airport, avg(is_delayed) AS delay_rate,
    count(*) AS n FROM scores GROUP BY 1""")}


@query("airport_delay_and_centrality", with_tables("scores", recursive=True, extra={**HUBS, **RATES}, body="""
SELECT airport, round(delay_rate, 9) AS delay_rate, n AS count, round(pagerank, 9) AS pagerank,
  round(betweenness, 9) AS betweenness FROM rates JOIN hubs USING (airport) WHERE n >= 300"""))
def airport_delay_and_centrality(spark, sf):
    return rounded(joins.airport_delay(base.scores(spark, sf), hubs(spark, sf)),
                   "delay_rate", "pagerank", "betweenness")


@query("map_airports", with_tables("scores", "airports", recursive=True, extra={**HUBS, **RATES}, body="""
SELECT airport, lat, lon, round(pagerank, 9) AS pagerank,
  round(coalesce(CASE WHEN n >= 100 THEN delay_rate END, 0), 9) AS delay_rate
FROM hubs JOIN airports USING (airport) LEFT JOIN rates USING (airport)
WHERE lat BETWEEN 24 AND 50 AND lon BETWEEN -125 AND -66"""))
def map_airports(spark, sf):
    return rounded(_map(spark, sf).select("airport", "lat", "lon", "pagerank", "delay_rate"),
                   "pagerank", "delay_rate")


def _map(spark, sf):
    placed = joins.with_coords(hubs(spark, sf), base.airports(spark, sf))
    return filters.within_box(joins.with_delay_rate(placed, base.scores(spark, sf)))


INSIDE = """(SELECT airport FROM airports WHERE lat BETWEEN 24 AND 50
  AND lon BETWEEN -125 AND -66)"""


@query("busiest_routes_on_map", with_tables("routes", "airports", body=f"""
SELECT "Origin", "Dest", n FROM (SELECT src AS "Origin", dest AS "Dest", weight AS n FROM routes
  ORDER BY weight DESC, src, dest LIMIT 50)
WHERE "Origin" IN {INSIDE} AND "Dest" IN {INSIDE}"""))
def busiest_routes_on_map(spark, sf):
    routes = graph.network(base.legs(spark, sf)).toDF("Origin", "Dest", "n")
    top = reshape.top_k(routes, "n", 50, ["Origin", "Dest"])
    return joins.routes_within(top, filters.within_box(base.airports(spark, sf)))


@query("heavy_routes", with_tables("routes", body="""
SELECT src AS "Origin", dest AS "Dest", weight AS n,
  round((weight - min(weight) OVER ()) / greatest(max(weight) OVER () - min(weight) OVER (), 1), 9)
    AS scaled FROM routes WHERE weight >= 100"""))
def heavy_routes(spark, sf):
    routes = graph.network(base.legs(spark, sf)).toDF("Origin", "Dest", "n").where("n >= 100")
    return rounded(reshape.min_max(routes, "n").orderBy(F.desc("n"), "Origin", "Dest"), "scaled")


@query("route_endpoints", with_tables("routes", "airports", body="""
SELECT airport, name, state FROM airports WHERE airport IN (
  SELECT src FROM routes WHERE weight >= 150 UNION SELECT dest FROM routes WHERE weight >= 150)"""))
def route_endpoints(spark, sf):
    routes = graph.network(base.legs(spark, sf)).toDF("Origin", "Dest", "n").where("n >= 150")
    return joins.endpoint_airports(base.airports(spark, sf), routes).select(
        "airport", "name", "state")


@query("route_miles", with_tables("routes", "airports", body="""
SELECT src AS "Origin", dest AS "Dest", round(coalesce(2 * 3958.8 * asin(sqrt(
    pow(sin(radians(d.lat - o.lat) / 2), 2) + cos(radians(o.lat)) * cos(radians(d.lat))
      * pow(sin(radians(d.lon - o.lon) / 2), 2))), 679), 6) AS miles
FROM routes LEFT JOIN (SELECT * FROM airports WHERE lat BETWEEN 24 AND 50) o ON src = o.airport
  LEFT JOIN (SELECT * FROM airports WHERE lat BETWEEN 24 AND 50) d ON dest = d.airport"""))
def route_miles(spark, sf):
    routes = graph.network(base.legs(spark, sf)).toDF("Origin", "Dest", "n")
    known = filters.within_box(base.airports(spark, sf))
    return rounded(joins.distances(routes, known).select("Origin", "Dest", "miles"), "miles",
                   digits=6)


@query("state_delay_rates", with_tables("scores", "airports", recursive=True, extra={**HUBS, **RATES}, body="""
SELECT state, round(avg(coalesce(CASE WHEN n >= 100 THEN delay_rate END, 0)), 9) AS delay_rate,
  string_agg(airport, ', ' ORDER BY airport) AS airports
FROM hubs JOIN airports USING (airport) LEFT JOIN rates USING (airport)
WHERE lat BETWEEN 24 AND 50 AND lon BETWEEN -125 AND -66 AND state IS NOT NULL GROUP BY 1"""))
def state_delay_rates(spark, sf):
    states = base.airports(spark, sf).select("airport", "state")
    return rounded(reports.state_rates(_map(spark, sf), states), "delay_rate")


@query("airport_names", with_tables("airports", recursive=True, extra=HUBS, body="""
SELECT h.airport, coalesce(a.name, h.airport) AS name
FROM hubs h LEFT JOIN airports a USING (airport)"""))
def airport_names(spark, sf):
    named = base.airports(spark, sf).select("airport", "name")
    return joins.with_label(hubs(spark, sf).select("airport"), "airport", named, "name")


@query("top_hubs", with_tables(recursive=True, extra=HUBS, body="""
SELECT airport, round(pagerank, 9) AS pagerank FROM (
  SELECT * FROM hubs ORDER BY pagerank DESC, airport LIMIT 20)"""))
def top_hubs(spark, sf):
    best = reshape.top_k(hubs(spark, sf), "pagerank", 20, "airport", display_ascending=True)
    return rounded(best.select("airport", "pagerank"), "pagerank")


@query("airport_risk_matrix", with_tables("scores", recursive=True, extra={**HUBS, **RATES,
    "m": (["rates", "hubs"], """SELECT airport, delay_rate, n, pagerank FROM rates
        JOIN hubs USING (airport) WHERE n >= 50"""),
    "q": (["m"], """SELECT *, CASE
        WHEN pagerank >= (SELECT quantile_cont(pagerank, 0.5) FROM m)
         AND delay_rate >= (SELECT quantile_cont(delay_rate, 0.5) FROM m)
          THEN 'High Risk (Important + Delayed)'
        WHEN delay_rate >= (SELECT quantile_cont(delay_rate, 0.5) FROM m)
          THEN 'Unreliable (Low Importance + Delayed)'
        WHEN pagerank >= (SELECT quantile_cont(pagerank, 0.5) FROM m)
          THEN 'Safe Hub (Important + On-Time)'
        ELSE 'Low Priority (Low Importance + On-Time)' END AS quadrant,
        pagerank >= (SELECT quantile_cont(pagerank, 0.8) FROM m)
          OR delay_rate >= (SELECT quantile_cont(delay_rate, 0.92) FROM m) AS show_label FROM m"""),
    "z": (["q"], """SELECT quadrant, quantile_cont(n, 0.95) AS top, min(n) AS low FROM q
        GROUP BY 1""")}, body="""
SELECT airport, quadrant, show_label, n AS count,
  round(8 + 22 * (least(n, top) - low) / (top - low + 1), 9) AS size FROM q JOIN z USING (quadrant)
"""))
def airport_risk_matrix(spark, sf):
    table = joins.airport_delay(base.scores(spark, sf), hubs(spark, sf), min_n=50)
    m = matrix.risk_matrix(table.select("airport", "pagerank", "delay_rate", "count"))
    return rounded(m.select("airport", "quadrant", "show_label", "count", "size"), "size")


# --- a network that grows with the tables ------------------------------------------------

@query("wide_network_summary", with_tables("wide_edges", extra={
    "wide_nodes": (["wide_edges"], "SELECT src AS a FROM wide_edges UNION SELECT dest FROM wide_edges")},
    body="""
SELECT (SELECT count(*) FROM wide_nodes) AS nodes, count(*) AS edges, CAST(sum(weight) AS BIGINT) AS flights,
  round(avg(weight), 9) AS flights_per_route,
  round(count(*) / ((SELECT count(*) FROM wide_nodes) * ((SELECT count(*) FROM wide_nodes) - 1)), 9)
    AS density FROM wide_edges"""))
def wide_network_summary(spark, sf):
    return rounded(graph.network_summary(base.wide_edges(spark, sf)), "flights_per_route", "density")


@query("wide_degree_centrality", with_tables("wide_edges", extra={
    "ends": (["wide_edges"], "SELECT src AS a FROM wide_edges UNION ALL SELECT dest FROM wide_edges")},
    body="""
SELECT a AS airport, count(*) AS degree,
  round(count(*) / ((SELECT count(DISTINCT a) FROM ends) - 1), 9) AS degree_centrality
FROM ends GROUP BY a"""))
def wide_degree_centrality(spark, sf):
    return rounded(graph.degree(base.wide_edges(spark, sf)), "degree_centrality")


#: Exact distances by levels; the network of the tables has a diameter of a few hops.
@query("sketched_closeness", with_tables("wide_edges", recursive=True, extra={
    "wide_nodes": (["wide_edges"], "SELECT src AS a FROM wide_edges UNION SELECT dest FROM wide_edges"),
    "walks": (["wide_nodes"], """SELECT a AS s, a AS v, 0 AS d FROM wide_nodes
      UNION SELECT s, dest, d + 1 FROM walks JOIN wide_edges ON v = src WHERE d < 8"""),
    "hops": (["walks"], "SELECT s, v, min(d) AS d FROM walks GROUP BY s, v")},
    body="""
SELECT v AS airport, round((count(*) - 1) * (count(*) - 1)
  / (sum(d)::DOUBLE * ((SELECT count(*) FROM wide_nodes) - 1)), 6) AS closeness_centrality
FROM hops GROUP BY v"""))
def sketched_closeness(spark, sf):
    """Closeness from sketches of the airports in reach, which are exact for few airports."""
    return rounded(graph.closeness_by_sketches(base.wide_edges(spark, sf)), "closeness_centrality",
                   digits=6)


@query("betweenness_within_bound")
def betweenness_within_bound(spark, sf):
    """Betweenness of all airports from as many sources as an error of 0.2 asks for."""
    return graph.betweenness_within(base.wide_edges(spark, sf), 0.2, cost="hops")
