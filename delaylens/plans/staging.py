"""Staging models and the cleaning chains of the profiling study."""

from pyspark.sql import DataFrame, functions as F

from delaylens import schemas as S
from delaylens.functions import columns as C
from delaylens.operators import dedup, filters, reshape


def stage_flights(raw: DataFrame, clip_hour=False) -> DataFrame:
    """Raw flights to 22 typed columns, one row per flight."""
    cause = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in S.CAUSE_COLUMNS}
    cap = S.DELAY_CAP
    return raw.select(
        C.joined_key(["flightdate", "reporting_airline", "flight_number_reporting_airline",
                      "origin", "crsdeptime"], "_").alias("flight_id"),
        F.col("flightdate").cast("date").alias("flight_date"),
        F.col("month").cast("long").alias("flight_month"),
        C.weekday_number(F.col("flightdate").cast("date")).alias("day_of_week"),
        C.hhmm_hour("crsdeptime", clip_hour).alias("scheduled_dep_hour"),
        F.col("reporting_airline").alias("airline_code"),
        F.col("flight_number_reporting_airline").cast("long").alias("flight_number"),
        F.col("tail_number"),
        F.col("origin").alias("origin_airport"),
        F.col("dest").alias("dest_airport"),
        F.col("distance").cast("double").alias("distance_miles"),
        C.cancelled_flag("cancelled").alias("is_cancelled"),
        F.col("cancellationcode").alias("cancellation_code"),
        F.lit(None).cast("double").alias("taxi_out_mins"),
        F.lit(None).cast("double").alias("taxi_in_mins"),
        C.clamp(F.col("depdelay").cast("double"), -cap, cap, 0).alias("dep_delay_minutes"),
        C.clamp(F.col("arrdelay").cast("double"), -cap, cap, 0).alias("arr_delay_minutes"),
        cause["weatherdelay"].alias("weather_delay_mins"),
        cause["nasdelay"].alias("nas_delay_mins"),
        cause["carrierdelay"].alias("carrier_delay_mins"),
        cause["securitydelay"].alias("security_delay_mins"),
        cause["lateaircraftdelay"].alias("late_aircraft_delay_mins"),
    )


def _weather_rows(df, ts, airport, source, ingested=None, **measures):
    kinds = {"temperature_c": "double", "precipitation_mm": "double",
             "wind_speed_knots": "double", "cloud_cover_total_pct": "long",
             "cloud_cover_low_pct": "long"}
    timed = df.withColumn("_ts", ts)
    missing = F.lit(None)
    return timed.select(
        F.col("_ts").alias("ts_utc"), F.to_date("_ts").alias("date_id"),
        F.hour("_ts").cast("long").alias("hour_id"), F.col(airport).alias("airport_id"),
        *[F.col(measures[m]).cast(t).alias(m) if m in measures else missing.cast(t).alias(m)
          for m, t in kinds.items()],
        (missing if ingested is None else F.col(ingested)).try_cast("timestamp")
        .alias("ingested_ts"),
        F.lit(source).alias("weather_source"),
        F.lit(S.WEATHER_PRIORITY[source]).alias("source_priority"))


def observation_hours(observations: DataFrame) -> DataFrame:
    """Station reports on the common weather columns; unreadable times are dropped."""
    return _weather_rows(
        observations, C.hour_start(F.col("obs_time").try_cast("timestamp")), "iata_code",
        "metar", "ingested_at", temperature_c="temp_c", wind_speed_knots="wind_speed_knots",
    ).where(F.col("ts_utc").isNotNull())


def archive_hours(archive: DataFrame) -> DataFrame:
    return _weather_rows(
        archive, F.col("time").cast("timestamp"), "airport_code", "openmeteo",
        temperature_c="temperature_2m", precipitation_mm="precipitation",
        wind_speed_knots="wind_speed_10m", cloud_cover_total_pct="cloud_cover",
        cloud_cover_low_pct="cloud_cover_low")


def forecast_hours(forecasts: DataFrame) -> DataFrame:
    """Forecast periods at their start hour; periods without a start are dropped."""
    return _weather_rows(
        forecasts, C.hour_start(F.timestamp_seconds(F.col("valid_from").cast("long"))),
        "iata_code", "taf", "ingested_at", wind_speed_knots="wind_speed_knots",
    ).where(F.col("ts_utc").isNotNull())


def weather_sources(archive: DataFrame, observations: DataFrame,
                    forecasts: DataFrame) -> DataFrame:
    """The three feeds on one set of columns."""
    return observation_hours(observations).unionByName(archive_hours(archive)).unionByName(
        forecast_hours(forecasts))


def best_source(rows: DataFrame) -> DataFrame:
    """One row per airport-hour: best source, then latest; measures break ties."""
    order = [F.asc("source_priority"), F.desc("ts_utc"), F.desc("ingested_ts"),
             F.desc("wind_speed_knots"), F.desc("temperature_c"), F.desc("precipitation_mm"),
             F.desc("cloud_cover_total_pct"), F.desc("cloud_cover_low_pct")]
    return dedup.first_per_key(rows.where(F.col("airport_id").isNotNull()),
                               ["airport_id", "date_id", "hour_id"], order)


def weather_columns(best: DataFrame) -> DataFrame:
    return best.select(
        C.joined_key(["airport_id", "date_id", "hour_id"], "_").alias("weather_id"),
        F.col("ts_utc").alias("time"), F.col("ts_utc").alias("time_parsed"), "date_id",
        "hour_id", "airport_id", "temperature_c", "precipitation_mm", "wind_speed_knots",
        "cloud_cover_total_pct", "cloud_cover_low_pct")


def stage_weather(archive: DataFrame, observations: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Three weather feeds to one row per (airport, date, hour)."""
    return weather_columns(best_source(weather_sources(archive, observations, forecasts)))


# --- cleaning chains ----------------------------------------------------------

CORE_FIELDS = ["DepDelay", "ArrDelay", "DepTime", "ArrTime"]
CAPPED_FIELDS = ["DepDelay", "DepDelayMinutes", "ArrDelay", "ArrDelayMinutes"]
CAUSE_FIELDS = ["WeatherDelay", "NASDelay", "CarrierDelay", "SecurityDelay", "LateAircraftDelay"]


def keep_relevant(raw: DataFrame) -> DataFrame:
    return reshape.select_existing(reshape.drop_prefix(raw, "Div", "Unnamed"), S.CLEAN_COLUMNS)


def operated_clean(kept: DataFrame) -> DataFrame:
    """Operated flights: causes filled, core fields present, delays capped, types set."""
    has = set(kept.columns)
    flown, _ = filters.split_operated(kept)
    flown = reshape.impute(flown, {c: 0 for c in CAUSE_FIELDS})
    flown = flown.dropna(subset=[c for c in CORE_FIELDS if c in has])
    capped = {c: C.clamp(c, -S.DELAY_CAP, S.DELAY_CAP) for c in CAPPED_FIELDS if c in has}
    return flown.withColumns({
        **capped, "Cancelled": C.cancelled_flag("Cancelled"),
        "FlightDate": F.col("FlightDate").cast("date")})


def keyed_flights(df: DataFrame) -> DataFrame:
    return df.withColumn("flight_id", C.joined_key(
        ["FlightDate", "Reporting_Airline",
         F.col("Flight_Number_Reporting_Airline").cast("long"), "Origin",
         F.col("CRSDepTime").cast("long")], "-"))


def clean_flights(raw: DataFrame, order=None) -> DataFrame:
    """The seven cleaning steps; duplicates keep the first row in ``order``."""
    keyed = keyed_flights(operated_clean(keep_relevant(raw)))
    return dedup.first_per_key(keyed, "flight_id", order or _stable_order(keyed))


def _stable_order(df):
    return [F.asc(c) for c in df.columns if c != "flight_id"]


WEATHER_NAMES = {
    "temperature_2m": "temperature_c", "wind_speed_10m": "wind_speed_knots",
    "precipitation": "precipitation_mm", "cloudcover_low": "cloud_cover_low_pct",
    "cloudcover": "cloud_cover_total_pct", "airport_code": "airport_id",
}


def clean_weather(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumn("time_parsed", F.col("time").cast("timestamp"))
    parsed = parsed.withColumns({
        "date_id": F.to_date("time_parsed"), "hour_id": F.hour("time_parsed").cast("long")})
    keyed = parsed.withColumn(
        "weather_id", C.joined_key(["airport_code", "date_id", "hour_id"], "-"))
    return reshape.rename(keyed, WEATHER_NAMES)
