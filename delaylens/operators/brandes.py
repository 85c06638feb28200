"""Dependencies of shortest paths, source by source, on a network that a task holds whole.

Sources are dealt to tasks; the routes reach them as a broadcast of packed numbers. A task keeps 8 bytes
a route (16 with costs), as much again while it sorts them, some 30 bytes an airport, and route lists
of about ``AT_ONCE``.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from delaylens.session import stored

#: Routes followed at a time.
AT_ONCE = 1 << 18


def packed(routes: DataFrame) -> DataFrame:
    """One row per Arrow batch of ``src, dest[, cost]``, each column as the bytes of its numbers."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([np.asarray(c).tobytes()], pa.binary()) for c in batch.columns],
                    names=batch.schema.names)

    return stored(routes.mapInArrow(run, ", ".join(f"{c} binary" for c in routes.columns)),
                  "packed-routes", free=True)


class Network:
    """Routes by origin; ``cost`` is None where every route counts 1."""

    def __init__(self, n, src, dest, cost=None):
        order = np.argsort(src, kind="stable")
        self.n, self.dest = n, dest[order]
        self.cost = None if cost is None else cost[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(src, minlength=n))])

    def leaving(self, airports):
        """(origin, destination, cost) of the routes from ``airports``, some ``AT_ONCE`` at a time."""
        ends = np.cumsum(self.first[airports + 1] - self.first[airports])
        at = 0
        while at < len(airports):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
            some, at = airports[at:stop], stop
            begin = self.first[some]
            count = self.first[some + 1] - begin
            route = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            yield np.repeat(some, count), self.dest[route], 1 if self.cost is None else self.cost[route]

    def distances(self, source):
        kind = np.dtype(np.int64) if self.cost is None else self.cost.dtype
        far = np.inf if kind.kind == "f" else np.iinfo(kind).max
        dist = np.full(self.n, far, kind)
        dist[source] = 0
        fresh = np.array([source])
        while len(fresh):
            better = np.zeros(self.n, bool)
            for a, b, cost in self.leaving(fresh):
                reach = dist[a] + cost
                gain = reach < dist[b]
                np.minimum.at(dist, b[gain], reach[gain])
                better[b[gain]] = True
            fresh = np.flatnonzero(better)
        return dist, far

    def dependencies(self, source):
        """How much the shortest paths from ``source`` depend on each airport (Brandes, 2001)."""
        dist, far = self.distances(source)
        order = np.argsort(dist, kind="stable")[:np.count_nonzero(dist < far)]
        groups = np.split(order, np.flatnonzero(np.diff(dist[order])) + 1)

        def tight(airports):
            for a, b, cost in self.leaving(airports):
                on = dist[a] + cost == dist[b]
                yield a[on], b[on]

        paths, through = np.zeros(self.n), np.zeros(self.n)
        paths[source] = 1
        for group in groups:
            for a, b in tight(group):
                np.add.at(paths, b, paths[a])
        for group in groups[::-1]:
            for a, b in tight(group):
                np.add.at(through, a, paths[a] / paths[b] * (1 + through[b]))
        through[source] = 0
        return through


def summed(routes: DataFrame, n, kinds, sources) -> DataFrame:
    """(id, s, q): sum of the dependencies / (n - 2) of the given range of sources, and of their squares.

    ``routes`` are ``packed``, numbered from 0, their numbers of the numpy ``kinds``.
    """
    spark = routes.sparkSession
    tasks = max(1, min(len(sources), spark.sparkContext.defaultParallelism))

    def run(batches):
        mine, parts = [], [[] for _ in kinds]
        for batch in batches:
            for row in range(batch.num_rows):
                task = batch.column(0)[row].as_py()
                mine += [] if task in mine else [task]
                if task == mine[0]:  # every task comes with all routes
                    for k, (kind, out) in enumerate(zip(kinds, parts)):
                        out.append(np.frombuffer(batch.column(k + 1)[row].as_buffer(), kind).copy())
        if not mine:
            return
        net = Network(n, *[np.concatenate(x) for x in parts])
        s, q = np.zeros(n), np.zeros(n)
        for source in [x for task in mine for x in sources[task::tasks]]:
            y = net.dependencies(source) / (n - 2)
            s += y
            q += y * y
        some = np.flatnonzero(s)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(s[some]), pa.array(q[some])],
                                         names=["id", "s", "q"])

    # at most WHOLE_ROUTES of graph.py are packed
    dealt = spark.range(0, tasks, 1, tasks).withColumnRenamed("id", "task").crossJoin(F.broadcast(routes))
    return dealt.mapInArrow(run, "id long, s double, q double")
