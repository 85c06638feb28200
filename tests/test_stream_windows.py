"""Event-time aggregates over several batches, with a restart in between."""

import collections
import datetime as dt
import json
import random

from delaylens.session import scratch
from delaylens.streaming import feeds, windows

BEGIN = dt.datetime(2024, 1, 1)


def reports(seed, n=240):
    rng = random.Random(seed)
    times = [BEGIN + dt.timedelta(minutes=rng.randrange(0, 4 * 24 * 60)) for _ in range(n)]
    rows = [{"icaoId": rng.choice(["KATL", "KX"]), "reportTime": t.isoformat(), "temp": float(k % 30),
             "wspd": float(k % 9), "ingested_at": "x"} for k, t in enumerate(times)]
    return rows + [{"icaoId": "KATL", "reportTime": "unreadable", "temp": 99.0, "ingested_at": "x"}]


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, rows)) + "\n")


def finished(query):
    query.awaitTermination()


def stations(rows):
    return [("ATL" if r["icaoId"] == "KATL" else r["icaoId"], dt.datetime.fromisoformat(r["reportTime"]),
             r["temp"], r["wspd"]) for r in rows if r["reportTime"] != "unreadable"]


def test_hours_are_kept_up_to_date(spark, tmp_path):
    rows, folder = reports(1), tmp_path / "landing"
    table, offsets = scratch(spark, "hourly"), scratch(spark, "offsets")
    for part in range(2):  # the second run goes on where the first one ended
        for k in range(2):
            land(folder, f"{part}{k}.json", rows[part * 2 + k::4])
        stream = feeds.observations(spark, str(folder), 1)
        finished(windows.keep_updated(windows.hourly(stream, "10 days"), table, offsets))
    want = collections.defaultdict(list)
    for code, at, temp, wind in stations(rows):
        want[code, at.replace(minute=0, second=0)].append((temp, wind))
    got = {(r.iata_code, r.hour_start): (r.reports, round(r.mean_temp_c, 9), r.max_wind_knots)
           for r in spark.read.parquet(table).collect()}
    assert got == {k: (len(v), round(sum(t for t, _ in v) / len(v), 9), max(w for _, w in v))
                   for k, v in want.items()}


def test_reports_behind_the_watermark_are_left_out(spark, tmp_path):
    folder = tmp_path / "landing"
    first = [{"icaoId": "KX", "reportTime": "2024-01-02T12:00:00", "temp": 1.0}]
    land(folder, "0.json", first)
    table, offsets = scratch(spark, "hourly"), scratch(spark, "offsets")
    finished(windows.keep_updated(
        windows.hourly(feeds.observations(spark, str(folder)), "1 hour"), table, offsets))
    land(folder, "1.json", [{"icaoId": "KX", "reportTime": t, "temp": 1.0}
                            for t in ("2024-01-02T01:00:00", "2024-01-02T11:30:00")])
    finished(windows.keep_updated(
        windows.hourly(feeds.observations(spark, str(folder)), "1 hour"), table, offsets))
    assert sorted((r.hour_start.hour, r.reports) for r in spark.read.parquet(table).collect()) == [
        (11, 1), (12, 1)]


def test_sessions(spark, tmp_path):
    rows, folder = reports(2, 60), tmp_path / "landing"
    for k in range(3):
        land(folder, f"{k}.json", rows[k::3])
    land(folder, "9.json", [{"icaoId": "KX", "reportTime": "2025-01-01T00:00:00", "temp": 0.0}])
    target = scratch(spark, "sessions")
    finished(windows.keep_closed(windows.sessions(
        feeds.observations(spark, str(folder), 1), "3 hours", "10 days"), target, scratch(spark, "offsets")))
    want = []
    for code in ("ATL", "KX"):
        times = sorted(at for c, at, *_ in stations(rows) if c == code)
        for at in times:
            if want and want[-1][0] == code and at <= want[-1][2] + dt.timedelta(hours=3):
                want[-1][2:] = [at, want[-1][3] + 1]
            else:
                want.append([code, at, at, 1])
    got = sorted([r.iata_code, r.first_report, r.last_report, r.reports]
                 for r in spark.read.parquet(target).collect())
    assert got == sorted(want)
