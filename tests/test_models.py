"""Staging, the fact table and history against plain-Python references."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from delaylens.operators import dedup, snapshot
from delaylens.plans import fact, staging

RAW = ("flightdate string, month int, reporting_airline string, "
       "flight_number_reporting_airline long, tail_number string, origin string, dest string, "
       "crsdeptime int, distance double, cancelled double, cancellationcode string, "
       "depdelay double, arrdelay double, weatherdelay double, nasdelay double, "
       "carrierdelay double, securitydelay double, lateaircraftdelay double")


def raw_row(**kw):
    base = dict(flightdate="2024-01-07", month=1, airline="AA", number=1, tail="N1", origin="ATL",
                dest="LAX", clock=905, distance=100.0, cancelled=0.0, code=None, dep=10.0, arr=5.0,
                weather=None, nas=None, carrier=None, security=None, late=None)
    base.update(kw)
    return tuple(base.values())


def test_stage_flights(spark):
    rows = [raw_row(), raw_row(number=2, dep=3777.0, arr=-800.0, clock=2400),
            raw_row(number=3, cancelled=1.0, dep=None, arr=None), raw_row(number=4, airline=None),
            raw_row(number=5, cancelled=None, clock=None)]
    out = {r["flight_number"]: r for r in
           staging.stage_flights(spark.createDataFrame(rows, RAW)).collect()}
    assert len(out[1].asDict()) == 22
    assert out[1]["flight_id"] == "2024-01-07_AA_1_ATL_905" and out[1]["day_of_week"] == 1
    assert (out[2]["dep_delay_minutes"], out[2]["arr_delay_minutes"]) == (720, -720)
    assert out[2]["scheduled_dep_hour"] == 24
    assert out[3]["is_cancelled"] is True and out[3]["dep_delay_minutes"] == 0
    assert out[4]["flight_id"] is None
    assert out[5]["is_cancelled"] is None and out[5]["flight_id"] is None
    assert out[1]["weather_delay_mins"] == 0


def test_weather_priority_is_by_row(spark):
    archive = spark.createDataFrame(
        [("ATL", "2024-01-01T05:00", 1.0, 0.5, 9.0, 80, 40), ("ATL", "2024-01-01T06:00", 2.0, 0.1,
                                                              8.0, 70, 30)],
        "airport_code string, time string, temperature_2m double, precipitation double, "
        "wind_speed_10m double, cloud_cover long, cloud_cover_low long")
    reports = spark.createDataFrame(
        [("ATL", "2024-01-01T05:10:00", 3.0, 11.0, "2024-01-01T05:20:00"),
         ("ATL", "2024-01-01T05:10:00", 4.0, 12.0, "2024-01-01T05:50:00"),
         ("ATL", "not a time", 9.0, 99.0, "2024-01-01T05:50:00")],
        "iata_code string, obs_time string, temp_c double, wind_speed_knots double, "
        "ingested_at string")
    epoch = int(dt.datetime(2024, 1, 1, 7, 30, tzinfo=dt.timezone.utc).timestamp())
    forecasts = spark.createDataFrame(
        [("ATL", epoch, 20.0, "2024-01-01T01:00:00"), ("ATL", None, 21.0, "2024-01-01T01:00:00")],
        "iata_code string, valid_from long, wind_speed_knots double, ingested_at string")
    out = {r["hour_id"]: r for r in
           staging.stage_weather(archive, reports, forecasts).collect()}
    assert sorted(out) == [5, 6, 7]
    # the observation wins the hour with its own NULLs, the later report first
    assert (out[5]["temperature_c"], out[5]["precipitation_mm"]) == (4.0, None)
    assert out[5]["weather_id"] == "ATL_2024-01-01_5"
    assert out[6]["precipitation_mm"] == 0.1
    assert out[7]["wind_speed_knots"] == 20.0 and out[7]["temperature_c"] is None


def flights_and_weather(seed, n=400):
    """Few airports, one of them with a third of the flights; gaps, NULLs and sparse days."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        origin = "HUB" if rng.random() < 0.34 else rng.choice(["A", "B", "C", None])
        day = None if rng.random() < 0.03 else dt.date(2024, 1, 1) + dt.timedelta(
            days=rng.choice([0, 0, 0, 1, 2, 5, 9, 9, 20]))
        rows.append((f"id{i:04d}", day, rng.choice([None, *range(6)]), "AA", i,
                     rng.choice([None, None, "T1", "T2", "T3"]), origin,
                     rng.choice(["HUB", "A", "B", "Z", None]), float(rng.randint(-20, 90)),
                     float(rng.randint(-20, 90)), float(rng.choice([0, 0, 0, 12]))))
    weather = [(a, dt.date(2024, 1, 1) + dt.timedelta(days=d), h, float(rng.randint(0, 40)))
               for a in ("HUB", "A", "B") for d in (0, 1, 5, 9) for h in range(6)
               if rng.random() < 0.6]
    return rows, weather


def staged(spark, rows, weather):
    f = spark.createDataFrame(
        rows, "flight_id string, flight_date date, scheduled_dep_hour long, airline_code string, "
              "flight_number long, tail_number string, origin_airport string, "
              "dest_airport string, dep_delay_minutes double, arr_delay_minutes double, "
              "weather_delay_mins double")
    zero = F.lit(0.0)
    f = f.withColumns({
        "flight_month": F.lit(1).cast("long"), "day_of_week": F.lit(1).cast("long"),
        "distance_miles": zero, "taxi_out_mins": zero, "taxi_in_mins": zero,
        "is_cancelled": F.lit(False), "cancellation_code": F.lit(None).cast("string"),
        "nas_delay_mins": zero, "carrier_delay_mins": zero, "security_delay_mins": zero,
        "late_aircraft_delay_mins": zero})
    w = spark.createDataFrame(
        weather, "airport_id string, date_id date, hour_id long, wind_speed_knots double")
    w = w.withColumns({"temperature_c": F.lit(1.0), "precipitation_mm": zero,
                       "cloud_cover_total_pct": F.lit(1).cast("long"),
                       "cloud_cover_low_pct": F.lit(1).cast("long")})
    return f, w


def expected_features(rows, weather):
    """The definition, one ordered list per group."""
    first = lambda v: (v is not None, v)
    order = lambda r: (first(r[1] and r[1].toordinal()), first(r[2]), r[0])
    wind_at = {(a, d, h): v for a, d, h, v in weather}
    wind = lambda r: wind_at.get((r[6], r[1], r[2])) if None not in (r[6], r[1], r[2]) else None
    out = defaultdict(dict)
    by_tail, by_origin, hours = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=order):
        by_tail[r[5]].append(r)
        by_origin[r[6]].append(r)
        hours[r[6], r[1], r[2]].append(r[8])
    for chain in by_tail.values():
        for before, r in zip([None, *chain], chain):
            out[r[0]]["tail"] = before and before[9]
    for chain in by_origin.values():
        for i, r in enumerate(chain):
            six, three = chain[max(0, i - 6):i], chain[max(0, i - 3):i]
            last = wind(chain[i - 1]) if i else None
            out[r[0]].update(
                avg=sum(x[8] for x in six) / len(six) if six else None, count=len(six),
                flag=max((int(x[10] > 0) for x in three), default=None),
                delta=None if last is None or wind(r) is None else wind(r) - last)
    timeline = defaultdict(list)
    for a, d, h in sorted(hours, key=lambda k: (first(k[0]), first(k[1] and k[1].toordinal()),
                                                first(k[2]))):
        timeline[a].append((d, h))
    before = {}
    for a, slots in timeline.items():
        for prev, slot in zip([None, *slots], slots):
            before[(a, *slot)] = prev and hours[(a, *prev)]
    for r in rows:
        got = before.get((r[7], r[1], r[2])) if None not in (r[7], r[1], r[2]) else None
        out[r[0]]["dest"] = got and (round(sum(got) / len(got), 9), len(got))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fact_matches_its_definition(spark, seed):
    rows, weather = flights_and_weather(seed)
    got = fact.build_fact(*staged(spark, rows, weather)).collect()
    want = expected_features(rows, weather)
    assert len(got) == len(rows) and len(got[0]) == 34
    for r in got:
        w = want[r["flight_id"]]
        avg = r["rolling_6_flight_origin_delay_avg"]
        assert r["lag_1_tail_arr_delay_mins"] == w["tail"], r
        assert (avg if avg is None else round(avg, 9)) == (w["avg"] and round(w["avg"], 9)), r
        assert r["rolling_6_flight_origin_count"] == w["count"], r
        assert r["rolling_3_flight_weather_delay_flag"] == w["flag"], r
        assert r["wind_speed_delta"] == w["delta"], r
        dest = r["dest_prev_hour_delay_avg"]
        assert (dest and round(dest, 9)) == (w["dest"] and w["dest"][0]), r
        assert r["dest_prev_hour_flight_count"] == (w["dest"] and w["dest"][1]), r


def test_tails_without_number_can_be_left_unchained(spark):
    rows, weather = flights_and_weather(4)
    out = fact.build_fact(*staged(spark, rows, weather), null_tail_chain=False)
    assert out.where("tail_number IS NULL AND lag_1_tail_arr_delay_mins IS NOT NULL").count() == 0


def test_model_input_keeps_operated_flights(spark):
    rows, weather = flights_and_weather(5)
    f, w = staged(spark, rows, weather)
    f = f.withColumn("is_cancelled", F.when(F.col("flight_number") < 10, True)
                     .when(F.col("flight_number") < 20, None).otherwise(False))
    out = fact.model_input(fact.build_fact(f, w))
    assert out.count() == len(rows) - 20
    assert out.where("temperature_c IS NULL OR wind_speed_delta IS NULL").count() == 0
    assert 0 < fact.model_input(fact.build_fact(f, w), 20).count() < out.count()


def test_clean_flights_keeps_the_first_duplicate(spark):
    columns = ("FlightDate string, Reporting_Airline string, "
               "Flight_Number_Reporting_Airline long, Origin string, Dest string, "
               "CRSDepTime long, DepTime double, DepDelay double, ArrTime double, "
               "ArrDelay double, Cancelled double, WeatherDelay double, Div1Airport string, "
               "Diverted double")
    row = lambda **kw: tuple({**dict(
        d="2024-01-01", a="AA", n=1, o="ATL", t="LAX", c=900, dt=901.0, dd=1.0, at=1000.0, ad=2.0,
        x=0.0, w=None, v=None, r=0.0), **kw}.values())
    raw = spark.createDataFrame([row(), row(dd=5.0), row(n=2, dd=9000.0), row(n=3, x=1.0),
                                 row(n=4, ad=None), row(n=5, x=None)], columns)
    out = {r["Flight_Number_Reporting_Airline"]: r for r in
           staging.clean_flights(raw, [F.asc("DepDelay")]).collect()}
    assert sorted(out) == [1, 2, 5]
    assert out[1]["DepDelay"] == 1.0 and out[2]["DepDelay"] == 720.0
    assert out[1]["flight_id"] == "2024-01-01-AA-1-ATL-900" and out[1]["WeatherDelay"] == 0
    assert "Diverted" not in out[1].asDict() and out[1]["Cancelled"] is False
    assert out[5]["Cancelled"] is None


def test_duplicates_lists_all_members(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")],
                               "k int, v string")
    assert sorted(r["v"] for r in dedup.duplicates(df, "k").collect()) == ["a", "b"]
    assert {r["v"] for r in dedup.first_per_key(df, "k", ["v"]).collect()} == {"a", "c", "d"}


# --- history ----------------------------------------------------------------------

def versions(df):
    return sorted((r["flight_id"] or "", r["x"] if r["x"] is not None else -1, str(r["valid_from"]),
                   str(r["valid_to"]), r["is_current"]) for r in df.collect())


def test_history(spark):
    frame = lambda rows: spark.createDataFrame(rows, "flight_id string, x int, note string")
    t0, t1, t2 = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")
    one = frame([("same", 1, "a"), ("change", 1, "a"), ("gone", 1, "a"), ("blank", None, "a"),
                 (None, 7, "a")])
    two = frame([("same", 1, "other"), ("change", 2, "b"), ("new", 5, "b"), ("blank", None, "b"),
                 (None, 8, "b")])
    step = lambda now, was, at: snapshot.snapshot_scd2(now, was, "flight_id", ["x"], at)
    first = snapshot.open_history(one, t0)
    second = step(two, first, t1)
    assert versions(second) == sorted([
        ("same", 1, t0, "None", True), ("change", 1, t0, t1, False),
        ("change", 2, t1, "None", True), ("gone", 1, t0, "None", True),
        ("new", 5, t1, "None", True), ("blank", -1, t0, "None", True),
        ("", 7, t0, "None", True), ("", 8, t1, "None", True)])
    keyed = two.where("flight_id IS NOT NULL")
    third = step(keyed, second, t2)  # nothing changed: the history stays
    assert versions(third) == versions(second)
    live = third.where("is_current AND flight_id IS NOT NULL")
    assert live.count() == live.select("flight_id").distinct().count()


def test_history_takes_one_of_repeated_keys(spark):
    day = "2024-01-0{} 00:00:00".format
    was = spark.createDataFrame([("a", 1.0, 5), ("b", 1.0, 5)], "flight_id string, x double, y int")
    now = spark.createDataFrame([("a", 3.0, 2), ("a", 2.0, 9), ("a", 2.0, 8), ("b", 1.0, 7),
                                 ("c", None, 1), ("c", None, 0)], was.schema)
    out = snapshot.snapshot_scd2(now, snapshot.open_history(was, day(1)), "flight_id", ["x"], day(2))
    live = sorted((r["flight_id"], r["x"] or 0, r["y"]) for r in out.where("is_current").collect())
    assert live == [("a", 2.0, 8), ("b", 1.0, 5), ("c", 0, 0)]
    assert out.where("NOT is_current").count() == 1


def test_weather_join_does_not_sort_the_flights(spark):
    """A sort for each window and the hour join, none for the weather; odd keys find no weather, no row is lost."""
    rows, weather = flights_and_weather(6)
    f, w = staged(spark, rows, weather)
    f = f.withColumns({
        "scheduled_dep_hour": F.when(F.col("flight_number") % 7 != 0, F.col("scheduled_dep_hour")),
        "origin_airport": F.when(F.col("flight_number") % 11 != 0, F.col("origin_airport"))})
    twice = f.unionByName(f.where("flight_number < 5"))
    daily = fact.daily_weather(w)
    keyed = fact.chunk_keys(twice.withColumnsRenamed(fact.FACT_NAMES), "origin_airport_id", "date_id")
    joined = fact._with_weather(keyed, daily)
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin [_g" in plan and "SortMergeJoin" not in plan
    known = {(r["airport_id"], r["date_id"], r["hour_id"]): r["wind_speed_knots"] for r in w.collect()
             if None not in (r["airport_id"], r["date_id"], r["hour_id"])}
    got = joined.collect()
    assert len(got) == twice.count()
    assert any(r["wind_speed_knots"] is not None for r in got)
    for r in got:
        assert r["wind_speed_knots"] == known.get((r["origin_airport_id"], r["date_id"], r["hour_id"])), r
