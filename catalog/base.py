"""Query registry, and flight tables derived from the driver's tables.

The driver's tables hold no flights, so flight, weather, route and score
tables are derived from whole tables with the same formulas in Spark and SQL.
"""

from pyspark.sql import DataFrame, functions as F

from delaylens.functions import columns as C
from delaylens.operators import graph, joins
from delaylens.plans import fact as fact_plan, staging
from delaylens.session import freed_shuffles, scratch

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Spark side ---------------------------------------------------------------

def _code(n):
    return F.concat(F.lit("A"), F.lpad(n.cast("string"), 2, "0"))


def events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def ontime(spark, sf_dir) -> DataFrame:
    """Raw flights (one per event)."""
    k, user = F.col("k"), F.col("user_id")
    e = events(spark, sf_dir)
    gone = k % 40 == 0
    dep = F.when(~gone, F.floor(F.col("value") * 3) - 60).cast("double")
    arr = F.when(k % 10 != 0, dep - k % 15)
    clock = (F.hour("ts") * 100 + F.minute("ts")).cast("int")
    causes = ["carrierdelay", "weatherdelay", "nasdelay", "securitydelay", "lateaircraftdelay"]
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("flightdate"),
        F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("dayofmonth"),
        F.col("event_type").alias("reporting_airline"),
        F.col("event_id").alias("flight_number_reporting_airline"),
        F.when(k != 13, user.cast("string")).alias("tail_number"),
        _code(user % 25).alias("origin"), _code(k % 25).alias("dest"),
        clock.alias("crsdeptime"),
        F.when(~gone, clock.cast("double")).alias("deptime"),
        F.when(k % 10 != 0, clock.cast("double")).alias("arrtime"),
        dep.alias("depdelay"), arr.alias("arrdelay"),
        F.when(k == 97, F.lit(None)).when(gone, 1.0).otherwise(0.0).alias("cancelled"),
        F.when(gone, F.element_at(F.array(*[F.lit(x) for x in "ABCD"]),
                                  (user % 4 + 1).cast("int"))).alias("cancellationcode"),
        F.lit(0.0).alias("diverted"),
        (200 + 37 * ((user + k) % 60)).cast("double").alias("distance"),
        *[F.when((dep > 15) & (k % 5 == i), dep).alias(c) for i, c in enumerate(causes)],
    )


def weather_feeds(spark, sf_dir, feeds=3):
    """(archive, observations, forecasts) in their landed shapes.

    Events are dealt to the three feeds by id; with one feed, each has all events.
    """
    e = events(spark, sf_dir)
    feed = F.col("event_id") % feeds
    k, airport = F.col("k"), _code(F.col("k") % 25)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    wind = (k % 40).cast("double")
    archive = e.where(feed == 0).select(
        airport.alias("airport_code"), stamp.alias("time"),
        (F.col("value") - 20).alias("temperature_2m"), (F.col("value") / 50).alias("precipitation"),
        wind.alias("wind_speed_10m"), k.cast("long").alias("cloud_cover"),
        F.floor(k / 2).cast("long").alias("cloud_cover_low"))
    observations = e.where(feed == (1 if feeds > 1 else 0)).select(
        airport.alias("iata_code"), F.when(k == 55, F.lit("unreadable")).otherwise(stamp)
        .alias("obs_time"), (F.col("value") - 20).alias("temp_c"),
        wind.alias("wind_speed_knots"), stamp.alias("ingested_at"))
    forecasts = e.where(feed == (2 if feeds > 1 else 0)).select(
        airport.alias("iata_code"),
        F.when(k != 77, F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("valid_from"),
        wind.alias("wind_speed_knots"), stamp.alias("ingested_at"))
    return archive, observations, forecasts


def stg_flights(spark, sf_dir):
    return staging.stage_flights(ontime(spark, sf_dir))


def stg_weather(spark, sf_dir):
    return staging.stage_weather(*weather_feeds(spark, sf_dir))


def fact(spark, sf_dir):
    """The fact over staged tables, as a daily job has them: each is derived and written once."""
    flights = once(spark, sf_dir, "stg_flights", lambda: stg_flights(spark, sf_dir))
    weather = once(spark, sf_dir, "stg_weather", lambda: stg_weather(spark, sf_dir))
    return fact_plan.build_fact(flights, weather)


_KEPT = {}


def once(spark, sf_dir, label, make, free=False) -> DataFrame:
    """A table that many queries need, written on first use in a session.

    With ``free`` the shuffle files of the write go when it ends.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _KEPT:
        path = scratch(spark, label)
        with freed_shuffles(spark, free):
            make().write.parquet(path)
        _KEPT[key] = path
    return spark.read.parquet(_KEPT[key])


#: Airports of the multi-year flights; each has routes to at most eight others.
LEG_AIRPORTS = 40


def legs(spark, sf_dir) -> DataFrame:
    """Multi-year flights between airports (one per line item)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag",
        "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey")))
    gone = F.col("l_linenumber") == 7
    late = F.datediff("l_shipdate", "o_orderdate").cast("double")
    origin = F.col("l_suppkey") % LEG_AIRPORTS
    dest = (origin * 3 + 1 + F.col("c_nationkey") % 8 * 5) % LEG_AIRPORTS
    return j.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("flightdate"),
        F.concat("l_returnflag", "l_linestatus").alias("reporting_airline"),
        F.col("l_orderkey").alias("flight_number_reporting_airline"),
        "l_linenumber", "l_partkey", "l_suppkey",
        _code(origin).alias("origin"), _code(dest).alias("dest"),
        F.when(gone, 1.0).otherwise(0.0).alias("cancelled"),
        F.when(~gone, late).alias("depdelay"))


def airports(spark, sf_dir) -> DataFrame:
    """Airport dimension: name, state and coordinates."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").withColumnRenamed("r_name", "state")
    key = F.col("n_nationkey")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        _code(key).alias("airport"), F.col("n_name").alias("name"), "state",
        F.when(key % 12 == 0, 60.0).otherwise((24 + (7 * key) % 27).cast("double")).alias("lat"),
        (-125 + (11 * key) % 60).cast("double").alias("lon"))


def scores(spark, sf_dir) -> DataFrame:
    """Scored flights with a score computed from the key, so SQL can follow."""
    f = stg_flights(spark, sf_dir)
    w = stg_weather(spark, sf_dir)
    late = C.is_delayed("dep_delay_minutes")
    j = joins.join_weather(f, w)
    points = C.hash_bucket("flight_number", 1001) + 250 * late
    return j.select(
        "flight_number", "flight_date", "airline_code", F.col("origin_airport").alias("Origin"),
        F.col("dest_airport").alias("Dest"), "scheduled_dep_hour",
        F.col("distance_miles").alias("Distance"), "dep_delay_minutes", "arr_delay_minutes",
        late.alias("is_delayed"), (points / 1250.0).alias("risk_score"),
        C.risk_label(points / 1250.0).alias("risk_label"),
        F.when(points / 1250.0 >= 0.5, 1).otherwise(0).alias("prediction"),
        "temperature_c", "precipitation_mm", "wind_speed_knots", "cloud_cover_total_pct",
        "cloud_cover_low_pct", "flight_month", "day_of_week", "weather_delay_mins")


def edges(spark, sf_dir) -> DataFrame:
    """Routes between different airports, with their flights."""
    return once(spark, sf_dir, "edges", lambda: graph.network(legs(spark, sf_dir)).where(
        "src <> dest"))


def wide_edges(spark, sf_dir) -> DataFrame:
    """Routes of a network that grows: one airport per supplier, to 17 others by customer."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    airports = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("n", airports)
    origin = F.col("l_suppkey") % F.col("n")
    dest = (origin * 3 + 1 + F.col("o_custkey") % 17 * 5) % F.col("n")
    flown = j.select(origin.cast("string").alias("origin"), dest.cast("string").alias("dest"))
    return once(spark, sf_dir, "wide-edges", lambda: graph.network(flown).where("src <> dest"), free=True)


def centrality(spark, sf_dir) -> DataFrame:
    """PageRank and betweenness of all airports, as the scoring job makes them."""
    return once(spark, sf_dir, "centrality", lambda: graph.centrality_scores(
        edges(spark, sf_dir)))


# --- SQL side -----------------------------------------------------------------

_CAUSE = "CASE WHEN depdelay > 15 AND k % 5 = {i} THEN depdelay END AS {c}"

CTES = {
    "ev": ([], """
        SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events"""),
    "ontime": (["ev"], """
        SELECT flightdate, year, month, dayofmonth, reporting_airline,
          flight_number_reporting_airline, tail_number, origin, dest, crsdeptime, deptime, arrtime,
          depdelay, CASE WHEN k % 10 <> 0 THEN depdelay - k % 15 END AS arrdelay, cancelled,
          cancellationcode, CAST(0 AS DOUBLE) AS diverted, distance,
          """ + ", ".join(_CAUSE.format(i=i, c=c) for i, c in enumerate(
              ["carrierdelay", "weatherdelay", "nasdelay", "securitydelay",
               "lateaircraftdelay"])) + """
        FROM (SELECT k, strftime(ts, '%Y-%m-%d') AS flightdate, CAST(year(ts) AS INTEGER) AS year,
          CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS dayofmonth,
          event_type AS reporting_airline, event_id AS flight_number_reporting_airline,
          CASE WHEN k <> 13 THEN CAST(user_id AS VARCHAR) END AS tail_number,
          'A' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS origin,
          'A' || lpad(CAST(k % 25 AS VARCHAR), 2, '0') AS dest,
          CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS crsdeptime,
          CASE WHEN k % 40 <> 0 THEN CAST(hour(ts) * 100 + minute(ts) AS DOUBLE) END AS deptime,
          CASE WHEN k % 10 <> 0 THEN CAST(hour(ts) * 100 + minute(ts) AS DOUBLE) END AS arrtime,
          CASE WHEN k % 40 <> 0 THEN CAST(floor(value * 3) - 60 AS DOUBLE) END AS depdelay,
          CASE WHEN k = 97 THEN NULL WHEN k % 40 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
            AS cancelled,
          CASE WHEN k % 40 = 0 THEN substr('ABCD', CAST(user_id % 4 + 1 AS BIGINT), 1) END
            AS cancellationcode,
          CAST(200 + 37 * ((user_id + k) % 60) AS DOUBLE) AS distance FROM ev)"""),
    "archive": (["ev"], """
        SELECT 'A' || lpad(CAST(k % 25 AS VARCHAR), 2, '0') AS airport_code,
          date_trunc('second', ts) AS t, value - 20 AS temperature_2m, value / 50 AS precipitation,
          CAST(k % 40 AS DOUBLE) AS wind_speed_10m, CAST(k AS BIGINT) AS cloud_cover,
          CAST(k // 2 AS BIGINT) AS cloud_cover_low
        FROM ev WHERE event_id % 3 = 0"""),
    "archive_all": (["ev"], """
        SELECT 'A' || lpad(CAST(k % 25 AS VARCHAR), 2, '0') AS airport_code,
          date_trunc('second', ts) AS t, value - 20 AS temperature_2m, value / 50 AS precipitation,
          CAST(k % 40 AS DOUBLE) AS wind_speed_10m, CAST(k AS BIGINT) AS cloud_cover,
          CAST(k // 2 AS BIGINT) AS cloud_cover_low
        FROM ev"""),
    "obs_all": (["ev"], """
        SELECT 'A' || lpad(CAST(k % 25 AS VARCHAR), 2, '0') AS iata_code,
          CASE WHEN k <> 55 THEN date_trunc('second', ts) END AS obs_time, value - 20 AS temp_c,
          CAST(k % 40 AS DOUBLE) AS wind_speed_knots, date_trunc('second', ts) AS ingested_at
        FROM ev"""),
    "obs": (["ev"], """
        SELECT 'A' || lpad(CAST(k % 25 AS VARCHAR), 2, '0') AS iata_code,
          CASE WHEN k <> 55 THEN date_trunc('second', ts) END AS obs_time, value - 20 AS temp_c,
          CAST(k % 40 AS DOUBLE) AS wind_speed_knots, date_trunc('second', ts) AS ingested_at
        FROM ev WHERE event_id % 3 = 1"""),
    "fcst": (["ev"], """
        SELECT 'A' || lpad(CAST(k % 25 AS VARCHAR), 2, '0') AS iata_code,
          CASE WHEN k <> 77 THEN date_trunc('second', ts) END AS valid_from,
          CAST(k % 40 AS DOUBLE) AS wind_speed_knots, date_trunc('second', ts) AS ingested_at
        FROM ev WHERE event_id % 3 = 2"""),
    "stg_flights": (["ontime"], """
        SELECT flightdate || '_' || reporting_airline || '_' || flight_number_reporting_airline
            || '_' || origin || '_' || crsdeptime AS flight_id,
          CAST(flightdate AS DATE) AS flight_date, CAST(month AS BIGINT) AS flight_month,
          CAST(dayofweek(CAST(flightdate AS DATE)) + 1 AS BIGINT) AS day_of_week,
          CAST(trunc(crsdeptime / 100) AS BIGINT) AS scheduled_dep_hour,
          reporting_airline AS airline_code,
          CAST(flight_number_reporting_airline AS BIGINT) AS flight_number, tail_number,
          origin AS origin_airport, dest AS dest_airport, distance AS distance_miles,
          CASE WHEN cancelled = 1 THEN TRUE WHEN cancelled = 0 THEN FALSE END AS is_cancelled,
          cancellationcode AS cancellation_code,
          CAST(NULL AS DOUBLE) AS taxi_out_mins, CAST(NULL AS DOUBLE) AS taxi_in_mins,
          CASE WHEN depdelay > 720 THEN 720 WHEN depdelay < -720 THEN -720
            ELSE coalesce(depdelay, 0) END AS dep_delay_minutes,
          CASE WHEN arrdelay > 720 THEN 720 WHEN arrdelay < -720 THEN -720
            ELSE coalesce(arrdelay, 0) END AS arr_delay_minutes,
          coalesce(weatherdelay, 0) AS weather_delay_mins, coalesce(nasdelay, 0) AS nas_delay_mins,
          coalesce(carrierdelay, 0) AS carrier_delay_mins,
          coalesce(securitydelay, 0) AS security_delay_mins,
          coalesce(lateaircraftdelay, 0) AS late_aircraft_delay_mins
        FROM ontime"""),
    "wx_rows": (["archive", "obs", "fcst"], """
        SELECT date_trunc('hour', obs_time) AS ts_utc, iata_code AS airport_id,
          temp_c AS temperature_c, CAST(NULL AS DOUBLE) AS precipitation_mm, wind_speed_knots,
          CAST(NULL AS BIGINT) AS cloud_cover_total_pct, CAST(NULL AS BIGINT) AS cloud_cover_low_pct,
          ingested_at AS ingested_ts, 'metar' AS weather_source, 1 AS source_priority
        FROM obs WHERE obs_time IS NOT NULL
        UNION ALL
        SELECT t, airport_code, temperature_2m, precipitation, wind_speed_10m, cloud_cover,
          cloud_cover_low, NULL, 'openmeteo', 2 FROM archive
        UNION ALL
        SELECT date_trunc('hour', valid_from), iata_code, NULL, NULL, wind_speed_knots, NULL, NULL,
          ingested_at, 'taf', 3 FROM fcst WHERE valid_from IS NOT NULL"""),
    "stg_weather": (["wx_rows"], """
        SELECT airport_id || '_' || CAST(date_id AS VARCHAR) || '_' || hour_id AS weather_id,
          ts_utc, date_id, hour_id, airport_id, temperature_c, precipitation_mm, wind_speed_knots,
          cloud_cover_total_pct, cloud_cover_low_pct
        FROM (SELECT *, row_number() OVER (PARTITION BY airport_id, date_id, hour_id
                ORDER BY source_priority, ts_utc DESC NULLS LAST, ingested_ts DESC NULLS LAST,
                  wind_speed_knots DESC NULLS LAST, temperature_c DESC NULLS LAST,
                  precipitation_mm DESC NULLS LAST, cloud_cover_total_pct DESC NULLS LAST,
                  cloud_cover_low_pct DESC NULLS LAST) AS rn
              FROM (SELECT *, CAST(ts_utc AS DATE) AS date_id,
                      CAST(hour(ts_utc) AS BIGINT) AS hour_id FROM wx_rows)
              WHERE airport_id IS NOT NULL)
        WHERE rn = 1"""),
    "joined": (["stg_flights", "stg_weather"], """
        SELECT f.*, w.temperature_c, w.precipitation_mm, w.wind_speed_knots,
          w.cloud_cover_total_pct, w.cloud_cover_low_pct
        FROM stg_flights f LEFT JOIN stg_weather w ON f.origin_airport = w.airport_id
          AND f.flight_date = w.date_id AND f.scheduled_dep_hour = w.hour_id"""),
    "hourly": (["joined"], """
        SELECT origin_airport AS airport_id, flight_date AS date_id, scheduled_dep_hour AS hour_id,
          avg(dep_delay_minutes) AS current_hour_delay_avg,
          count(flight_id) AS current_hour_flight_count
        FROM joined GROUP BY ALL"""),
    "shifted": (["hourly"], """
        SELECT airport_id, date_id, hour_id,
          lag(current_hour_delay_avg) OVER w AS prev_hour_delay_avg,
          lag(current_hour_flight_count) OVER w AS prev_hour_flight_count
        FROM hourly WINDOW w AS (PARTITION BY airport_id ORDER BY date_id, hour_id)"""),
    "fact": (["joined", "shifted"], """
        SELECT j.flight_id, j.flight_date AS date_id, j.scheduled_dep_hour AS hour_id,
          j.airline_code AS airline_id, j.flight_number, j.tail_number,
          j.origin_airport AS origin_airport_id, j.dest_airport AS dest_airport_id,
          j.flight_month, j.day_of_week, j.distance_miles, j.taxi_out_mins, j.taxi_in_mins,
          j.is_cancelled, j.cancellation_code, j.dep_delay_minutes, j.arr_delay_minutes,
          j.weather_delay_mins, j.nas_delay_mins, j.carrier_delay_mins, j.security_delay_mins,
          j.late_aircraft_delay_mins, j.temperature_c, j.precipitation_mm, j.wind_speed_knots,
          j.cloud_cover_total_pct, j.cloud_cover_low_pct,
          lag(j.arr_delay_minutes) OVER (PARTITION BY j.tail_number
            ORDER BY j.flight_date, j.scheduled_dep_hour, j.flight_id)
            AS lag_1_tail_arr_delay_mins,
          avg(j.dep_delay_minutes) OVER (o ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
            AS rolling_6_flight_origin_delay_avg,
          count(j.dep_delay_minutes) OVER (o ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
            AS rolling_6_flight_origin_count,
          d.prev_hour_delay_avg AS dest_prev_hour_delay_avg,
          d.prev_hour_flight_count AS dest_prev_hour_flight_count,
          j.wind_speed_knots - lag(j.wind_speed_knots) OVER o AS wind_speed_delta,
          max(CASE WHEN j.weather_delay_mins > 0 THEN 1 ELSE 0 END)
            OVER (o ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
            AS rolling_3_flight_weather_delay_flag
        FROM joined j LEFT JOIN shifted d ON j.dest_airport = d.airport_id
          AND j.flight_date = d.date_id AND j.scheduled_dep_hour = d.hour_id
        WINDOW o AS (PARTITION BY j.origin_airport
          ORDER BY j.flight_date, j.scheduled_dep_hour, j.flight_id)"""),
    "legs": ([], """
        SELECT strftime(l_shipdate, '%Y-%m-%d') AS flightdate,
          l_returnflag || l_linestatus AS reporting_airline,
          l_orderkey AS flight_number_reporting_airline, l_linenumber, l_partkey, l_suppkey,
          'A' || lpad(CAST(l_suppkey % 40 AS VARCHAR), 2, '0') AS origin,
          'A' || lpad(CAST((l_suppkey % 40 * 3 + 1 + c_nationkey % 8 * 5) % 40 AS VARCHAR), 2, '0')
            AS dest,
          CASE WHEN l_linenumber = 7 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cancelled,
          CASE WHEN l_linenumber <> 7 THEN
            CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) END AS depdelay
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey"""),
    "airports": ([], """
        SELECT 'A' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS airport, n_name AS name,
          r_name AS state,
          CAST(CASE WHEN n_nationkey % 12 = 0 THEN 60 ELSE 24 + (7 * n_nationkey) % 27 END
            AS DOUBLE) AS lat,
          CAST(-125 + (11 * n_nationkey) % 60 AS DOUBLE) AS lon
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "scores": (["joined"], """
        SELECT flight_number, flight_date, airline_code, origin_airport AS "Origin",
          dest_airport AS "Dest", scheduled_dep_hour, distance_miles AS "Distance",
          dep_delay_minutes, arr_delay_minutes, is_delayed, points / 1250.0::DOUBLE AS risk_score,
          CASE WHEN points / 1250.0::DOUBLE > 0 AND points / 1250.0::DOUBLE <= 0.3::DOUBLE
                 THEN 'Low'
               WHEN points / 1250.0::DOUBLE > 0.3::DOUBLE AND points / 1250.0::DOUBLE <= 0.6::DOUBLE
                 THEN 'Medium'
               WHEN points / 1250.0::DOUBLE > 0.6::DOUBLE THEN 'High' END AS risk_label,
          CASE WHEN points / 1250.0::DOUBLE >= 0.5 THEN 1 ELSE 0 END AS prediction,
          temperature_c, precipitation_mm, wind_speed_knots, cloud_cover_total_pct,
          cloud_cover_low_pct, flight_month, day_of_week, weather_delay_mins
        FROM (SELECT *, CASE WHEN dep_delay_minutes > 15 THEN 1 ELSE 0 END AS is_delayed,
            ('0x' || substr(md5(CAST(flight_number AS VARCHAR)), 1, 8))::BIGINT % 1001
            + 250 * CASE WHEN dep_delay_minutes > 15 THEN 1 ELSE 0 END AS points
          FROM joined)"""),
    "routes": (["legs"], """
        SELECT origin AS src, dest, count(*) AS weight FROM legs GROUP BY ALL"""),
    "edges": (["routes"], """
        SELECT src, dest, weight FROM routes WHERE src <> dest"""),
    "wide_edges": ([], """
        SELECT src, dest, count(*) AS weight FROM (
          SELECT CAST(a AS VARCHAR) AS src, CAST((a * 3 + 1 + o_custkey % 17 * 5) % n AS VARCHAR) AS dest
          FROM (SELECT l_suppkey % n AS a, o_custkey, n FROM lineitem
              JOIN orders ON l_orderkey = o_orderkey CROSS JOIN (SELECT count(*) AS n FROM supplier)))
        WHERE src <> dest GROUP BY ALL"""),
}


def with_tables(*names, body, extra=None, recursive=False):
    """A SELECT with the derived tables it needs placed before it."""
    order, extra = [], dict(extra or {})

    def visit(n):
        if n in order:
            return
        for parent in (extra[n][0] if n in extra else CTES[n][0]):
            visit(parent)
        order.append(n)

    for n in [*names, *extra]:
        visit(n)
    parts = [f"{n} AS ({(extra[n] if n in extra else CTES[n])[1]})" for n in order]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body
