"""Column helpers and the cleaning chains."""

from pyspark.sql import functions as F

from catalog import base
from catalog.base import query, with_tables
from catalog.reports import rounded
from delaylens.functions import columns as C
from delaylens.operators import filters, reports, reshape
from delaylens.plans import staging

STUDY_NAMES = {
    "flightdate": "FlightDate", "reporting_airline": "Reporting_Airline",
    "flight_number_reporting_airline": "Flight_Number_Reporting_Airline",
    "tail_number": "Tail_Number", "origin": "Origin", "dest": "Dest",
    "crsdeptime": "CRSDepTime", "deptime": "DepTime", "arrtime": "ArrTime",
    "depdelay": "DepDelay", "arrdelay": "ArrDelay", "cancelled": "Cancelled",
    "cancellationcode": "CancellationCode", "diverted": "Diverted", "distance": "Distance",
    "month": "Month", "weatherdelay": "WeatherDelay", "nasdelay": "NASDelay",
    "carrierdelay": "CarrierDelay", "securitydelay": "SecurityDelay",
    "lateaircraftdelay": "LateAircraftDelay",
}


def study(spark, sf):
    """Raw flights as the profiling study reads them, junk columns included."""
    return base.ontime(spark, sf).withColumnsRenamed(STUDY_NAMES).withColumns({
        "Div1Airport": F.lit(None).cast("string"), "Unnamed: 109": F.lit(None).cast("string")})


CLEAN = {"clean": (["ontime"], """
    SELECT CAST(flightdate AS DATE) AS "FlightDate", reporting_airline AS "Reporting_Airline",
      flight_number_reporting_airline AS "Flight_Number_Reporting_Airline", origin AS "Origin",
      dest AS "Dest", crsdeptime AS "CRSDepTime", deptime AS "DepTime",
      least(720, greatest(-720, depdelay)) AS "DepDelay", arrtime AS "ArrTime",
      least(720, greatest(-720, arrdelay)) AS "ArrDelay",
      CASE WHEN cancelled = 1 THEN TRUE WHEN cancelled = 0 THEN FALSE END AS "Cancelled",
      cancellationcode AS "CancellationCode", coalesce(weatherdelay, 0) AS "WeatherDelay",
      coalesce(nasdelay, 0) AS "NASDelay", coalesce(carrierdelay, 0) AS "CarrierDelay",
      coalesce(securitydelay, 0) AS "SecurityDelay",
      coalesce(lateaircraftdelay, 0) AS "LateAircraftDelay", month AS "Month",
      distance AS "Distance", flightdate || '-' || reporting_airline || '-'
        || flight_number_reporting_airline || '-' || origin || '-' || crsdeptime AS flight_id
    FROM ontime WHERE (cancelled IS NULL OR cancelled <> 1) AND depdelay IS NOT NULL
      AND arrdelay IS NOT NULL AND deptime IS NOT NULL AND arrtime IS NOT NULL""")}


@query("clean_flights", with_tables(extra=CLEAN, body="SELECT * FROM clean"))
def clean_flights(spark, sf):
    return staging.clean_flights(study(spark, sf))


@query("cleaning_steps", with_tables("ontime", extra=CLEAN, body="""
SELECT CAST(1 AS INTEGER) AS position, 'relevant' AS step, count(*) AS row_count,
  CAST(19 AS INTEGER) AS column_count, sum((deptime IS NULL)::INT + (arrtime IS NULL)::INT
    + (depdelay IS NULL)::INT + (arrdelay IS NULL)::INT + (cancelled IS NULL)::INT
    + (cancellationcode IS NULL)::INT + (weatherdelay IS NULL)::INT + (nasdelay IS NULL)::INT
    + (carrierdelay IS NULL)::INT + (securitydelay IS NULL)::INT
    + (lateaircraftdelay IS NULL)::INT)::BIGINT AS null_cells FROM ontime
UNION ALL
SELECT 2, 'operated', count(*), 19, sum(("Cancelled" IS NULL)::INT
  + ("CancellationCode" IS NULL)::INT)::BIGINT FROM clean
UNION ALL
SELECT 3, 'clean', count(*), 20, sum(("Cancelled" IS NULL)::INT
  + ("CancellationCode" IS NULL)::INT)::BIGINT FROM clean"""))
def cleaning_steps(spark, sf):
    raw = study(spark, sf)
    kept = staging.keep_relevant(raw)
    return reports.step_counts(relevant=kept, operated=staging.operated_clean(kept),
                               clean=staging.clean_flights(raw))


@query("clean_weather", with_tables("archive_all", body="""
SELECT airport_code AS airport_id, strftime(t, '%Y-%m-%dT%H:%M:%S') AS time,
  strftime(t, '%Y-%m-%d %H:%M:%S') AS time_parsed, CAST(t AS DATE) AS date_id,
  CAST(hour(t) AS BIGINT) AS hour_id, airport_code || '-' || CAST(CAST(t AS DATE) AS VARCHAR)
    || '-' || hour(t) AS weather_id, temperature_2m AS temperature_c,
  precipitation AS precipitation_mm, wind_speed_10m AS wind_speed_knots, cloud_cover, cloud_cover_low
FROM archive_all"""))
def clean_weather(spark, sf):
    archive, _, _ = base.weather_feeds(spark, sf, feeds=1)
    return staging.clean_weather(archive).withColumn(
        "time_parsed", F.date_format("time_parsed", "yyyy-MM-dd HH:mm:ss"))


@query("clock_and_calendar", with_tables("ontime", body="""
SELECT flight_number_reporting_airline AS n, CAST(dayofweek(d) + 1 AS BIGINT) AS weekday,
  strftime(d, '%A') AS weekday_name, strftime(d, '%a') AS weekday_label,
  strftime(d, '%b %Y') AS month_label, CAST(crsdeptime // 100 AS BIGINT) AS hour,
  CAST(greatest(0, least(23, coalesce(crsdeptime // 100, 0))) AS BIGINT) AS clipped_hour,
  lpad(CAST(crsdeptime // 100 AS VARCHAR), 2, '0') || ':'
    || lpad(CAST(crsdeptime % 100 AS VARCHAR), 2, '0') AS clock,
  strftime(d + to_minutes(crsdeptime // 100 * 60 + crsdeptime % 100), '%Y-%m-%d %H:%M')
    AS departure,
  strftime(d + to_minutes(crsdeptime // 100 * 60 + crsdeptime % 100), '%Y-%m-%d  %H:%M UTC')
    AS shown
FROM (SELECT *, CAST(flightdate AS DATE) AS d FROM ontime)"""))
def clock_and_calendar(spark, sf):
    day = F.col("flightdate").cast("date")
    departure = C.hhmm_timestamp(day, "crsdeptime")
    return base.ontime(spark, sf).select(
        F.col("flight_number_reporting_airline").alias("n"),
        C.weekday_number(day).alias("weekday"), C.weekday_name(day).alias("weekday_name"),
        C.weekday_label(C.weekday_number(day)).alias("weekday_label"),
        C.month_label("year", "month").alias("month_label"),
        C.hhmm_hour("crsdeptime").alias("hour"),
        C.hhmm_hour("crsdeptime", clip=True).alias("clipped_hour"),
        C.hhmm_text("crsdeptime").alias("clock"),
        F.date_format(departure, "yyyy-MM-dd HH:mm").alias("departure"),
        C.display_time(departure).alias("shown"))


@query("status_and_keys", with_tables("ontime", body="""
SELECT flightdate || '_' || reporting_airline || '_' || flight_number_reporting_airline || '_'
    || tail_number AS key_with_tail,
  CASE WHEN cancelled = 1 THEN TRUE WHEN cancelled = 0 THEN FALSE END AS is_cancelled,
  CASE WHEN depdelay IS NULL THEN NULL ELSE least(180, greatest(-60, depdelay)) END AS shown_delay,
  coalesce(CASE WHEN depdelay IS NULL THEN NULL ELSE least(720, greatest(-720, depdelay)) END, 0)
    AS capped_delay,
  CAST(CASE WHEN depdelay > 15 THEN 1 ELSE 0 END AS INTEGER) AS is_delayed,
  ('0x' || substr(md5(CAST(flight_number_reporting_airline AS VARCHAR)), 1, 8))::BIGINT % 100
    AS bucket FROM ontime"""))
def status_and_keys(spark, sf):
    return base.ontime(spark, sf).select(
        C.joined_key(["flightdate", "reporting_airline", "flight_number_reporting_airline",
                      "tail_number"], "_").alias("key_with_tail"),
        C.cancelled_flag("cancelled").alias("is_cancelled"),
        C.clamp("depdelay", -60, 180).alias("shown_delay"),
        C.clamp("depdelay", -720, 720, 0).alias("capped_delay"),
        C.is_delayed("depdelay").alias("is_delayed"),
        C.hash_bucket("flight_number_reporting_airline").alias("bucket"))


@query("score_bands_per_flight", with_tables("scores", body="""
SELECT flight_number, round(risk_score, 9) AS risk_score, risk_label,
  CASE WHEN risk_score < 0.3::DOUBLE THEN 'Low' WHEN risk_score < 0.6::DOUBLE THEN 'Medium'
    ELSE 'High' END AS band FROM scores"""))
def score_bands_per_flight(spark, sf):
    s = base.scores(spark, sf)
    return rounded(s.select("flight_number", "risk_score", "risk_label",
                            C.risk_band("risk_score").alias("band")), "risk_score")


@query("causes_in_long_form", with_tables("ontime", body=" UNION ALL ".join(
    f"SELECT flight_number_reporting_airline AS n, '{c}' AS cause, {c} AS minutes FROM ontime "
    f"WHERE {c} IS NOT NULL" for c in ("carrierdelay", "weatherdelay", "nasdelay",
                                       "securitydelay", "lateaircraftdelay"))))
def causes_in_long_form(spark, sf):
    f = base.ontime(spark, sf).withColumnRenamed("flight_number_reporting_airline", "n")
    long = reshape.melt(f.select("n", "carrierdelay", "weatherdelay", "nasdelay", "securitydelay",
                                 "lateaircraftdelay"), ["n"],
                        ["carrierdelay", "weatherdelay", "nasdelay", "securitydelay",
                         "lateaircraftdelay"], "cause", "minutes")
    return long.dropna(subset=["minutes"])


@query("local_flights", with_tables("ontime", body="""
SELECT flight_number_reporting_airline AS n, reporting_airline AS airline_code,
  CAST(month AS INTEGER) AS flight_month, CAST(crsdeptime // 100 AS BIGINT) AS scheduled_dep_hour,
  least(720, greatest(-720, coalesce(depdelay, 0))) AS depdelay,
  CAST(CASE WHEN depdelay > 15 THEN 1 ELSE 0 END AS INTEGER) AS is_delayed
FROM ontime WHERE cancelled IS NULL OR cancelled <> 1"""))
def local_flights(spark, sf):
    flown, _ = filters.split_operated(base.ontime(spark, sf))
    return flown.select(
        F.col("flight_number_reporting_airline").alias("n"),
        F.col("reporting_airline").alias("airline_code"),
        F.col("month").alias("flight_month"),
        C.hhmm_hour("crsdeptime", clip=True).alias("scheduled_dep_hour"),
        C.clamp("depdelay", -720, 720, 0).alias("depdelay"),
        C.is_delayed("depdelay").alias("is_delayed"))
