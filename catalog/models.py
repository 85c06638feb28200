"""Staging models, the fact table and its parts, history."""

import datetime as dt

from pyspark.sql import functions as F

from catalog import base
from catalog.base import query, with_tables
from catalog.reports import rounded
from delaylens.functions import columns as C
from delaylens.operators import dedup, joins, snapshot
from delaylens.plans import fact as plan, staging, upkeep
from delaylens.session import scratch, stored
from delaylens.sources import tables
from delaylens.sources.history import BucketedHistory


def _stamp(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


@query("staged_flights", with_tables("stg_flights", body="SELECT * FROM stg_flights"))
def staged_flights(spark, sf):
    return base.stg_flights(spark, sf)


@query("staged_weather", with_tables("stg_weather", body="""
SELECT * EXCLUDE (ts_utc), strftime(ts_utc, '%Y-%m-%d %H:%M:%S') AS time,
  strftime(ts_utc, '%Y-%m-%d %H:%M:%S') AS time_parsed FROM stg_weather"""))
def staged_weather(spark, sf):
    return _stamp(base.stg_weather(spark, sf), "time", "time_parsed")


@query("unified_weather_rows", with_tables("wx_rows", body="""
SELECT weather_source, CAST(source_priority AS INTEGER) AS source_priority, count(*) AS n,
  count(temperature_c) AS with_temperature, count(precipitation_mm) AS with_precipitation,
  count(wind_speed_knots) AS with_wind, count(cloud_cover_total_pct) AS with_cloud,
  count(ingested_ts) AS with_ingested FROM wx_rows GROUP BY 1, 2"""))
def unified_weather_rows(spark, sf):
    rows = staging.weather_sources(*base.weather_feeds(spark, sf))
    return rows.groupBy("weather_source", "source_priority").agg(
        F.count(F.lit(1)).alias("n"), F.count("temperature_c").alias("with_temperature"),
        F.count("precipitation_mm").alias("with_precipitation"),
        F.count("wind_speed_knots").alias("with_wind"),
        F.count("cloud_cover_total_pct").alias("with_cloud"),
        F.count("ingested_ts").alias("with_ingested"))


@query("flights_with_weather", with_tables("joined", body="""
SELECT flight_id, temperature_c, precipitation_mm, wind_speed_knots, cloud_cover_total_pct,
  cloud_cover_low_pct FROM joined"""))
def flights_with_weather(spark, sf):
    j = joins.join_weather(base.stg_flights(spark, sf), base.stg_weather(spark, sf))
    return j.select("flight_id", *joins.WEATHER_MEASURES)


@query("weather_match_rate", with_tables("joined", body="""
SELECT count(temperature_c) AS matched, count(*) AS total,
  round(count(temperature_c) / count(*) * 100, 9) AS matched_pct FROM joined"""))
def weather_match_rate(spark, sf):
    j = joins.join_weather(base.stg_flights(spark, sf), base.stg_weather(spark, sf))
    return rounded(joins.match_rate(j), "matched_pct")


def _named(spark, sf):
    return base.stg_flights(spark, sf).withColumnsRenamed(plan.FACT_NAMES)


@query("airport_hour_conditions", with_tables("hourly", body="""
SELECT airport_id, date_id, hour_id, round(current_hour_delay_avg, 9) AS current_hour_delay_avg,
  current_hour_flight_count FROM hourly"""))
def airport_hour_conditions(spark, sf):
    return rounded(plan.airport_hour(_named(spark, sf)), "current_hour_delay_avg")


@query("previous_hour_conditions", with_tables("shifted", body="""
SELECT airport_id, date_id, hour_id, round(prev_hour_delay_avg, 9) AS prev_hour_delay_avg,
  prev_hour_flight_count FROM shifted"""))
def previous_hour_conditions(spark, sf):
    return rounded(plan.prev_hour(plan.airport_hour(_named(spark, sf))), "prev_hour_delay_avg")


@query("destination_congestion", with_tables("fact", body="""
SELECT flight_id, round(dest_prev_hour_delay_avg, 9) AS dest_prev_hour_delay_avg,
  dest_prev_hour_flight_count FROM fact"""))
def destination_congestion(spark, sf):
    f = _named(spark, sf)
    j = joins.join_prev_hour(f, plan.prev_hour(plan.airport_hour(f)))
    return rounded(j.select("flight_id", "dest_prev_hour_delay_avg",
                            "dest_prev_hour_flight_count"), "dest_prev_hour_delay_avg")


@query("aircraft_previous_arrival", with_tables("fact", body="""
SELECT flight_id, tail_number, lag_1_tail_arr_delay_mins FROM fact"""))
def aircraft_previous_arrival(spark, sf):
    return plan.tail_lag(_named(spark, sf)).select(
        "flight_id", "tail_number", "lag_1_tail_arr_delay_mins")


@query("aircraft_previous_arrival_known_tails", with_tables("fact", body="""
SELECT flight_id, CASE WHEN tail_number IS NOT NULL THEN lag_1_tail_arr_delay_mins END
  AS lag_1_tail_arr_delay_mins FROM fact"""))
def aircraft_previous_arrival_known_tails(spark, sf):
    return plan.tail_lag(_named(spark, sf), null_tail_chain=False).select(
        "flight_id", "lag_1_tail_arr_delay_mins")


FLOATS = ["rolling_6_flight_origin_delay_avg", "dest_prev_hour_delay_avg", "wind_speed_delta"]


@query("flight_weather_fact", with_tables("fact", body="SELECT * REPLACE (" + ", ".join(
    f"round({c}, 9) AS {c}" for c in FLOATS) + ") FROM fact"))
def flight_weather_fact(spark, sf):
    return rounded(base.fact(spark, sf), *FLOATS)


@query("fact_after_corrections", with_tables("fact", body="SELECT * REPLACE (" + ", ".join(
    f"round({c}, 9) AS {c}" for c in FLOATS) + ") FROM fact"))
def fact_after_corrections(spark, sf):
    """The fact after a corrected day, a late day and late weather, kept up to date day by day.

    At first the 10th has other delays and aircraft, the 15th is missing, and so is the weather of
    the 12th. The days then arrive as they are, two updates in a row.
    """
    flights = base.once(spark, sf, "stg_flights", lambda: base.stg_flights(spark, sf))
    weather = base.once(spark, sf, "stg_weather", lambda: base.stg_weather(spark, sf))
    landing, store = scratch(spark, "landing"), scratch(spark, "upkeep")
    fixed, dry, late = (dt.date(2024, 1, d) for d in (10, 12, 15))
    wrong = F.col("flight_date") == F.lit(fixed)
    early = flights.where(F.col("flight_date") != F.lit(late)).withColumns({
        "dep_delay_minutes": F.when(wrong, F.col("dep_delay_minutes") + 7)
        .otherwise(F.col("dep_delay_minutes")),
        "tail_number": F.when(wrong, F.substring("tail_number", 1, 1))
        .otherwise(F.col("tail_number"))})
    tables.write_table(early, f"{landing}/flights", partition_by=["flight_date"])
    tables.write_table(weather.where(F.col("date_id") != F.lit(dry)), f"{landing}/weather",
                       partition_by=["date_id"])

    def landed():
        return (spark.read.schema(flights.schema).parquet(f"{landing}/flights"),
                spark.read.schema(weather.schema).parquet(f"{landing}/weather"))

    upkeep.build(*landed(), store)
    tables.replace_partitions(flights.where(F.col("flight_date") == F.lit(fixed)),
                              f"{landing}/flights", "flight_date")
    tables.replace_partitions(weather.where(F.col("date_id") == F.lit(dry)), f"{landing}/weather",
                              "date_id")
    upkeep.refresh(*landed(), store, [fixed, dry])
    tables.replace_partitions(flights.where(F.col("flight_date") == F.lit(late)),
                              f"{landing}/flights", "flight_date")
    upkeep.refresh(*landed(), store, [late])
    return rounded(upkeep.read_fact(spark, store), *FLOATS)


@query("model_input", with_tables("fact", body="""
SELECT flight_id, date_id AS flight_date, flight_month, day_of_week,
  hour_id AS scheduled_dep_hour, airline_id AS airline_code, tail_number,
  origin_airport_id AS "Origin", dest_airport_id AS "Dest", distance_miles AS "Distance",
  coalesce(temperature_c, 24.5) AS temperature_c, coalesce(precipitation_mm, 0) AS precipitation_mm,
  coalesce(wind_speed_knots, 5) AS wind_speed_knots,
  coalesce(CAST(cloud_cover_total_pct AS DOUBLE), 22) AS cloud_cover_total_pct,
  coalesce(CAST(cloud_cover_low_pct AS DOUBLE), 0) AS cloud_cover_low_pct,
  coalesce(lag_1_tail_arr_delay_mins, 0) AS lag_1_tail_arr_delay_mins,
  round(coalesce(rolling_6_flight_origin_delay_avg, 0), 9) AS rolling_6_flight_origin_delay_avg,
  coalesce(wind_speed_delta, 0) AS wind_speed_delta,
  CAST(coalesce(rolling_3_flight_weather_delay_flag, 0) AS DOUBLE)
    AS rolling_3_flight_weather_delay_flag,
  round(coalesce(dest_prev_hour_delay_avg, 0), 9) AS dest_prev_hour_delay_avg,
  CAST(coalesce(dest_prev_hour_flight_count, 0) AS DOUBLE) AS dest_prev_hour_flight_count,
  dep_delay_minutes, arr_delay_minutes, weather_delay_mins
FROM fact WHERE is_cancelled = FALSE
  AND ('0x' || substr(md5(flight_id), 1, 8))::BIGINT % 100 < 20"""))
def model_input(spark, sf):
    return rounded(plan.model_input(base.fact(spark, sf), 20),
                   "rolling_6_flight_origin_delay_avg", "dest_prev_hour_delay_avg")


@query("latest_observation_per_airport", with_tables("obs_all", body="""
SELECT iata_code, strftime(obs_time, '%Y-%m-%dT%H:%M:%S') AS obs_time, temp_c, wind_speed_knots
FROM (SELECT *, row_number() OVER (PARTITION BY iata_code ORDER BY ingested_at DESC,
    temp_c DESC, wind_speed_knots DESC) AS rn FROM obs_all) WHERE rn = 1"""))
def latest_observation_per_airport(spark, sf):
    _, observations, _ = base.weather_feeds(spark, sf, feeds=1)
    latest = dedup.latest_by(observations, "iata_code", [
        F.desc("ingested_at"), F.desc("temp_c"), F.desc("wind_speed_knots")])
    readable = F.when(F.col("obs_time") != "unreadable", F.col("obs_time"))
    return latest.select("iata_code", readable.alias("obs_time"), "temp_c", "wind_speed_knots")


LEG_KEY = ["flight_number_reporting_airline", "l_linenumber"]


@query("duplicate_rows", with_tables("legs", body="""
SELECT flight_number_reporting_airline, l_linenumber, l_partkey, l_suppkey, flightdate FROM legs
WHERE (flight_number_reporting_airline, l_linenumber) IN (
  SELECT (flight_number_reporting_airline, l_linenumber) FROM legs
  GROUP BY flight_number_reporting_airline, l_linenumber HAVING count(*) > 1)"""))
def duplicate_rows(spark, sf):
    return dedup.duplicates(base.legs(spark, sf), LEG_KEY).select(
        *LEG_KEY, "l_partkey", "l_suppkey", "flightdate")


@query("first_row_per_key", with_tables("legs", body="""
SELECT flight_number_reporting_airline, l_linenumber, l_partkey, l_suppkey, flightdate FROM (
  SELECT *, row_number() OVER (PARTITION BY flight_number_reporting_airline, l_linenumber
    ORDER BY l_partkey, l_suppkey, flightdate) AS rn FROM legs) WHERE rn = 1"""))
def first_row_per_key(spark, sf):
    return dedup.first_per_key(base.legs(spark, sf), LEG_KEY, [
        "l_partkey", "l_suppkey", "flightdate"]).select(
        *LEG_KEY, "l_partkey", "l_suppkey", "flightdate")


SNAP = ["flight_id", "dep_delay_minutes", "arr_delay_minutes", "weather_delay_mins",
        "temperature_c", "wind_speed_knots"]


@query("type2_history", with_tables("joined", extra={
    "v1": (["joined"], f"""SELECT {', '.join(SNAP)} FROM joined
      WHERE flight_date <= DATE '2024-01-20'"""),
    "v2": (["joined"], f"""SELECT {', '.join(SNAP)} FROM (
      SELECT * REPLACE (CASE WHEN arr_delay_minutes > 60 THEN arr_delay_minutes + 1
        ELSE arr_delay_minutes END AS arr_delay_minutes) FROM joined
      WHERE flight_date >= DATE '2024-01-10')"""),
    "changed": (["v1", "v2"], """SELECT v1.flight_id FROM v1 JOIN v2 USING (flight_id)
      WHERE v1.dep_delay_minutes IS DISTINCT FROM v2.dep_delay_minutes
        OR v1.arr_delay_minutes IS DISTINCT FROM v2.arr_delay_minutes
        OR v1.weather_delay_mins IS DISTINCT FROM v2.weather_delay_mins
        OR v1.temperature_c IS DISTINCT FROM v2.temperature_c
        OR v1.wind_speed_knots IS DISTINCT FROM v2.wind_speed_knots"""),
}, body="""
SELECT v1.*, '2024-02-01' AS valid_from,
  CASE WHEN flight_id IN (SELECT flight_id FROM changed) THEN '2024-03-01' END AS valid_to,
  flight_id NOT IN (SELECT flight_id FROM changed) AS is_current FROM v1
UNION ALL
SELECT v2.*, '2024-03-01', NULL, TRUE FROM v2
WHERE flight_id IN (SELECT flight_id FROM changed)
  OR flight_id NOT IN (SELECT flight_id FROM v1)"""))
def type2_history(spark, sf):
    """First extract up to the 20th; the second from the 10th on, with corrected arrivals."""
    j = stored(joins.join_weather(base.stg_flights(spark, sf), base.stg_weather(spark, sf)).select(
        "flight_date", *SNAP), "joined")
    arrival = F.col("arr_delay_minutes")
    first = j.where("flight_date <= DATE '2024-01-20'").select(*SNAP)
    second = j.where("flight_date >= DATE '2024-01-10'").withColumn(
        "arr_delay_minutes", F.when(arrival > 60, arrival + 1).otherwise(arrival)).select(*SNAP)
    history = snapshot.snapshot_scd2(second, snapshot.open_history(first, "2024-02-01 00:00:00"),
                                     as_of="2024-03-01 00:00:00")
    return history.withColumns({c: F.date_format(c, "yyyy-MM-dd")
                                for c in ("valid_from", "valid_to")})


#: Three extracts of the joined flights: columns as SQL, and which rows each has.
EXTRACTS = [
    ("2024-02-01 00:00:00", {}, "flight_date <= DATE '2024-01-20' AND flight_number % 7 <> 0"),
    ("2024-03-01 00:00:00", {"arr_delay_minutes": "arr_delay_minutes + 1", "when": "arr_delay_minutes > 60"},
     "flight_date >= DATE '2024-01-10' AND flight_number % 5 <> 0"),
    ("2024-04-01 00:00:00", {"dep_delay_minutes": "dep_delay_minutes - 1", "when": "dep_delay_minutes > 400"},
     "flight_date >= DATE '2024-01-05'"),
]


def _extract(change, rows):
    """Select list and filter of an extract, read alike by Spark and the checking SQL."""
    column = next((c for c in change if c != "when"), None)
    names = ["flight_number", *SNAP]
    return ", ".join(
        f"CASE WHEN {change['when']} THEN {change[c]} ELSE {c} END AS {c}" if c == column else c
        for c in names), rows


def _observed():
    return " UNION ALL ".join(
        f"SELECT {names}, '{at}' AS seen_on FROM joined WHERE {rows}"
        for at, (names, rows) in ((at, _extract(c, r)) for at, c, r in EXTRACTS))


@query("bucketed_history", with_tables("joined", extra={
    "observed": (["joined"], _observed()),
    "starts": (["observed"], f"""SELECT * FROM (SELECT *,
        lag(struct_pack({', '.join(f'{c} := {c}' for c in SNAP[1:])})) OVER w AS before,
        row_number() OVER w AS rn FROM observed WINDOW w AS (PARTITION BY flight_id ORDER BY seen_on))
      WHERE rn = 1 OR struct_pack({', '.join(f'{c} := {c}' for c in SNAP[1:])})
        IS DISTINCT FROM before"""),
}, body=f"""
SELECT flight_number, {', '.join(SNAP)}, seen_on AS valid_from,
  lead(seen_on) OVER w AS valid_to, lead(seen_on) OVER w IS NULL AS is_current
FROM starts WINDOW w AS (PARTITION BY flight_id ORDER BY seen_on)"""))
def bucketed_history(spark, sf):
    """Three snapshots of changing extracts in bucketed tables."""
    j = stored(joins.join_weather(base.stg_flights(spark, sf), base.stg_weather(spark, sf)).select(
        "flight_date", "flight_number", *SNAP), "joined")
    history = BucketedHistory(spark, scratch(spark, "history"), j.drop("flight_date").schema)
    for at, change, rows in EXTRACTS:
        names, kept = _extract(change, rows)
        history.snapshot(j.where(kept).selectExpr(*names.split(", ")), at)
    return _stamp(history.history(), "valid_from", "valid_to")
