"""Centrality against brute force on small graphs."""

import heapq
import os
import random
from itertools import permutations

import numpy as np
import pytest

from delaylens.operators import brandes, graph
from delaylens.session import scratch


def sample(seed, n=9, p=0.28):
    rng = random.Random(seed)
    edges = {(a, b): rng.randint(1, 4) for a in range(n) for b in range(n)
             if a != b and rng.random() < p}
    edges[(0, n)] = 2  # n has no departures
    return edges


def frame(spark, edges):
    return spark.createDataFrame(
        [(f"n{a}", f"n{b}", w) for (a, b), w in edges.items()], "src string, dest string, weight long")


def shortest(edges, source, cost):
    dist, queue = {source: 0}, [(0, source)]
    while queue:
        d, u = heapq.heappop(queue)
        if d > dist[u]:
            continue
        for (a, b), w in edges.items():
            if a == u and d + cost(w) < dist.get(b, float("inf")):
                dist[b] = d + cost(w)
                heapq.heappush(queue, (dist[b], b))
    return dist


def all_paths(edges, dist, source, target, cost):
    if source == target:
        return [[source]]
    return [p + [target] for (a, b), w in edges.items() if b == target and a in dist
            and dist[a] + cost(w) == dist[b] for p in all_paths(edges, dist, source, a, cost)]


def brute_betweenness(edges, cost, sources=None):
    names = sorted({x for e in edges for x in e})
    n, score = len(names), dict.fromkeys(names, 0.0)
    for s, t in permutations(names, 2):
        if sources is not None and s not in sources:
            continue
        dist = shortest(edges, s, cost)
        if t in dist:
            paths = all_paths(edges, dist, s, t, cost)
            for p in paths:
                for v in p[1:-1]:
                    score[v] += 1 / len(paths)
    scale = 1 / ((n - 1) * (n - 2)) * (1 if sources is None else n / len(sources))
    return {f"n{v}": x * scale for v, x in score.items()}


@pytest.mark.parametrize("seed,kind,cost", [(1, "weight", lambda w: w), (2, "hops", lambda w: 1)])
def test_betweenness(spark, seed, kind, cost):
    edges = sample(seed)
    got = {r[0]: r[1] for r in graph.betweenness(frame(spark, edges), kind).collect()}
    want = brute_betweenness(edges, cost)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_sampled_betweenness_uses_the_pivots(spark):
    edges = sample(3)
    df = frame(spark, edges)
    chosen = {int(r[0][1:]) for r in graph.pivots(df, 4).collect()}
    got = {r[0]: r[1] for r in graph.betweenness(df, "weight", 4).collect()}
    want = brute_betweenness(edges, lambda w: w, chosen)
    assert len(chosen) == 4 and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    every = {r[0]: r[1] for r in graph.betweenness(df, "weight", 99).collect()}
    want = brute_betweenness(edges, lambda w: w)
    assert all(abs(every[k] - want[k]) < 1e-12 for k in want)


def test_closeness(spark):
    edges = sample(4)
    names = sorted({x for e in edges for x in e})
    got = {r[0]: r[1] for r in graph.closeness(frame(spark, edges)).collect()}
    for v in names:
        into = [d[v] for s in names if s != v and v in (d := shortest(edges, s, lambda w: 1))]
        want = len(into) ** 2 / (sum(into) * (len(names) - 1)) if into else 0.0
        assert abs(got[f"n{v}"] - want) < 1e-12


def test_pagerank_is_the_fixed_point(spark):
    edges = sample(5)
    df = frame(spark, edges)
    got = {r[0]: r[1] for r in graph.pagerank(df, tol=1e-12).collect()}
    assert abs(sum(got.values()) - 1) < 1e-9
    n, out = len(got), {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    idle = sum(v for k, v in got.items() if int(k[1:]) not in out)
    for name, value in got.items():
        into = sum(got[f"n{a}"] * w / out[a] for (a, b), w in edges.items() if f"n{b}" == name)
        assert abs(value - (0.15 / n + 0.85 * (into + idle / n))) < 1e-9
    with pytest.raises(RuntimeError):
        graph.pagerank(df, tol=1e-15, max_iter=2)


def test_degree_strength_and_summary(spark):
    df = frame(spark, {(0, 1): 5, (1, 0): 1, (1, 2): 2})
    degree = {r["airport"]: (r["degree"], r["degree_centrality"])
              for r in graph.degree(df).collect()}
    assert degree == {"n0": (2, 1.0), "n1": (3, 1.5), "n2": (1, 0.5)}
    strength = {r[0]: tuple(r)[1:] for r in graph.strength(df).collect()}
    assert strength == {"n0": (5, 1, 6), "n1": (3, 5, 8), "n2": (0, 2, 2)}
    s = graph.network_summary(df).first()
    assert (s["nodes"], s["edges"], s["flights"], s["density"]) == (3, 3, 8, 0.5)
    sub = graph.subgraph(df, spark.createDataFrame([("n0",), ("n1",)], "airport string"))
    assert sorted(r["width"] for r in sub.collect()) == [0.2, 1.0]


def test_closeness_by_sketches(spark):
    edges = sample(4)
    exact = {r[0]: r[1] for r in graph.closeness(frame(spark, edges)).collect()}
    got = {r[0]: r[1] for r in graph.closeness_by_sketches(frame(spark, edges)).collect()}
    assert got.keys() == exact.keys() and all(abs(got[k] - exact[k]) < 1e-9 for k in exact)


def test_coarse_sketches_keep_their_error(spark):
    """600 airports on a ring with chords, 16 registers: counts are off by some tens of percent."""
    n = 600
    edges = {(a, (a + step) % n): 1 for a in range(n) for step in (1, 50)}
    dist = shortest(edges, 0, lambda w: 1)  # the same for every airport
    want = (n - 1) ** 2 / (sum(dist.values()) * (n - 1))
    for lg_k, error in ((12, 0.05), (4, 0.8)):
        df = graph.closeness_by_sketches(frame(spark, edges), lg_k)
        values = [r[1] for r in df.collect()]
        assert len(values) == n
        assert abs(sum(values) / n / want - 1) < error


def test_betweenness_within_its_bound(spark):
    rng = random.Random(8)
    edges = {(a, b): 1 for a in range(60) for b in rng.sample(range(60), 5) if a != b}
    df = frame(spark, edges)
    exact = {r[0]: r[1] for r in graph.betweenness(df, "hops").collect()}
    some = {r.airport: r for r in graph.betweenness_within(df, 0.3, cost="hops", batch=12).collect()}
    used = next(iter(some.values())).sources
    assert some.keys() == exact.keys() and used < 60
    assert all(r.bound <= 0.3 and abs(r.betweenness - exact[k]) <= r.bound for k, r in some.items())
    whole = graph.betweenness_within(df, 0.0, cost="hops", batch=40).collect()
    assert all(r.bound == 0 and r.sources == 60 and abs(r.betweenness - exact[r.airport]) < 1e-12
               for r in whole)


def test_networks_of_one_route(spark):
    df = frame(spark, {(0, 1): 3})
    assert {tuple(r) for r in graph.betweenness_within(df).collect()} == {
        ("n0", 0.0, 0.0, 2), ("n1", 0.0, 0.0, 2)}
    assert {tuple(r) for r in graph.closeness_by_sketches(df).collect()} == {("n0", 0.0), ("n1", 1.0)}


def test_sketches_free_their_disk(spark, monkeypatch):
    """Sketches of earlier rounds go; a round in parts gives the same closeness."""
    n = 50
    rng = random.Random(5)
    edges = frame(spark, {(a, b): 1 for a in range(n) for b in rng.sample(range(n), 3) if a != b})
    whole = {r[0]: r[1] for r in graph.closeness_by_sketches(edges).collect()}
    seen = []
    monkeypatch.setattr(graph, "scratch", lambda *a: seen.append(scratch(*a)) or seen[-1])
    parts = {r[0]: r[1] for r in graph.closeness_by_sketches(edges, transit=4096 * 45).collect()}
    assert parts == whole
    left = [p for p in seen if os.path.isdir(p)]
    assert len(seen) > 3 and len(left) == 1 and sorted(os.listdir(left[0])) == list("0123")


@pytest.mark.parametrize("cost", ["hops", "weight", "inverse"])
def test_betweenness_by_whole_networks_and_by_joins(spark, cost, monkeypatch):
    """Tasks that hold the network give what the joins over all routes give; a null airport has no routes."""
    rng = random.Random(11)
    rows = [(f"n{a}", f"n{b}", rng.randint(1, 3)) for a in range(25) for b in rng.sample(range(25), 3)]
    rows += rows[:5] + [("n3", "n3", 2), (None, "n1", 1), ("n2", None, 1), ("x", "y", 1)]
    df = spark.createDataFrame(rows, "src string, dest string, weight long")
    joined = {r[0]: tuple(r)[1:] for r in graph.betweenness_within(
        df, 0.0, cost=cost, batch=20, whole_routes=0).collect()}
    monkeypatch.setattr(graph, "dependencies", None)  # not needed where tasks hold the network
    whole = {r[0]: tuple(r)[1:] for r in graph.betweenness_within(df, 0.0, cost=cost, batch=20).collect()}
    assert joined.keys() == whole.keys() and None in whole
    assert all(abs(joined[k][0] - whole[k][0]) < 1e-12 and joined[k][1:] == whole[k][1:] for k in whole)


def test_routes_are_followed_in_pieces(monkeypatch):
    edges = sample(6, 14, 0.4)
    src, dest, weight = (np.array(x) for x in zip(*[(a, b, w) for (a, b), w in edges.items()]))
    want = brute_betweenness(edges, lambda w: w, {0})
    for most in (1 << 18, 3):
        monkeypatch.setattr(brandes, "AT_ONCE", most)
        got = brandes.Network(15, src, dest, weight).dependencies(0) * 15 / (14 * 13)
        assert all(abs(got[int(k[1:])] - v) < 1e-12 for k, v in want.items())
