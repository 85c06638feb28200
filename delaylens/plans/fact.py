"""The feature fact table: flights, weather, congestion and history features.

Each flight row is shuffled three times: by aircraft and day, by destination
hour, and by origin and day. Weather is folded to one row per airport and day,
so the weather join and the origin features share the last shuffle. Groups are
handled one day at a time (see ``operators.running``), so a hub airport or the
flights without a tail number never meet in one task.
"""

from pyspark.sql import DataFrame, Window as W, functions as F

from delaylens import schemas as S
from delaylens.functions import columns as C
from delaylens.operators.joins import WEATHER_MEASURES, join_prev_hour
from delaylens.operators.running import chunk_keys, with_previous

FACT_NAMES = {
    "flight_date": "date_id", "scheduled_dep_hour": "hour_id", "airline_code": "airline_id",
    "origin_airport": "origin_airport_id", "dest_airport": "dest_airport_id",
}

FACT_COLUMNS = [
    "flight_id", "date_id", "hour_id", "airline_id", "flight_number", "tail_number",
    "origin_airport_id", "dest_airport_id", "flight_month", "day_of_week", "distance_miles",
    "taxi_out_mins", "taxi_in_mins", "is_cancelled", "cancellation_code", "dep_delay_minutes",
    "arr_delay_minutes", "weather_delay_mins", "nas_delay_mins", "carrier_delay_mins",
    "security_delay_mins", "late_aircraft_delay_mins", *WEATHER_MEASURES,
    "lag_1_tail_arr_delay_mins", "rolling_6_flight_origin_delay_avg",
    "rolling_6_flight_origin_count", "dest_prev_hour_delay_avg", "dest_prev_hour_flight_count",
    "wind_speed_delta", "rolling_3_flight_weather_delay_flag",
]

DAY_ORDER = ["hour_id", "flight_id"]  # within one day


def airport_hour(flights: DataFrame) -> DataFrame:
    """Average delay and flight count per origin airport, date and hour."""
    return flights.groupBy(F.col("origin_airport_id").alias("airport_id"), "date_id", "hour_id").agg(
        F.avg("dep_delay_minutes").alias("current_hour_delay_avg"),
        F.count("flight_id").alias("current_hour_flight_count"))


def prev_hour(hours: DataFrame) -> DataFrame:
    """Conditions of the previous observed hour of the airport.

    The input is aggregated: its rows per airport are bounded by the calendar.
    """
    w = W.partitionBy("airport_id").orderBy("date_id", "hour_id")
    return hours.select(
        "airport_id", "date_id", "hour_id",
        F.lag("current_hour_delay_avg").over(w).alias("prev_hour_delay_avg"),
        F.lag("current_hour_flight_count").over(w).alias("prev_hour_flight_count"))


def hour_history(hours: DataFrame, carry: DataFrame) -> DataFrame:
    """As ``prev_hour``, for any whole days, with the last hour before each day from a table."""
    avg, n = "current_hour_delay_avg", "current_hour_flight_count"
    features = {f"prev_hour_{name}": (
        1, lambda w, c=c: F.lag(c).over(w), lambda here, rows, c=c: F.get(rows, F.lit(0))[c])
        for name, c in (("delay_avg", avg), ("flight_count", n))}
    keyed = chunk_keys(hours, "airport_id", "date_id")
    return with_previous(keyed, ["hour_id"], [avg, n], features, carry=carry).drop("_g", "_d", avg, n)


def tail_lag(flights: DataFrame, null_tail_chain=True, carry=None) -> DataFrame:
    """Arrival delay of the aircraft's previous flight.

    Flights without a tail number form one chain, or none at all when
    ``null_tail_chain`` is off.
    """
    keyed = chunk_keys(flights, "tail_number", "date_id")
    payload = ["arr_delay_minutes"]
    narrow = keyed.select("_g", "_d", *DAY_ORDER, *payload)
    features = {"lag_1_tail_arr_delay_mins": (
        1, lambda w: F.lag("arr_delay_minutes").over(w),
        lambda here, rows: F.get(rows, F.lit(0))["arr_delay_minutes"])}
    out = with_previous(keyed, DAY_ORDER, payload, features, narrow, carry).drop("_g", "_d")
    if not null_tail_chain:
        out = out.withColumn("lag_1_tail_arr_delay_mins", F.when(
            F.col("tail_number").isNotNull(), F.col("lag_1_tail_arr_delay_mins")))
    return out


def daily_weather(weather: DataFrame) -> DataFrame:
    """Weather as one row per airport and day: a map from hour to measures.

    Needs unique airport-hours, which makes a day at most 24 entries.
    """
    known = weather.where(F.col("airport_id").isNotNull() & F.col("date_id").isNotNull()
                          & F.col("hour_id").isNotNull())
    entry = F.struct("hour_id", F.struct(*WEATHER_MEASURES))
    return (known.groupBy(C.group_token("airport_id").alias("_g"), F.col("date_id").alias("_d"))
            .agg(F.map_from_entries(F.collect_list(entry)).alias("_wx")))


def _with_weather(keyed, daily):
    """Weather of the hour; the rows are dealt by ``_g`` and ``_d`` as the windows after it need them.

    The days are hashed, as there is one row for each airport and day: a merge join would sort the flights
    once more, by less than the windows sort them.
    """
    found = F.try_element_at("_wx", F.col("hour_id"))
    joined = keyed.join(daily.hint("shuffle_hash"), ["_g", "_d"], "left").withColumn(
        "_w", F.when(F.col("hour_id").isNotNull(), found))
    return joined.withColumns({m: F.col("_w")[m] for m in WEATHER_MEASURES}).drop("_wx", "_w")


def _total(rows, field):
    return F.aggregate(rows, F.lit(0.0), lambda a, r: a + F.coalesce(r[field], F.lit(0.0)))


def _present(rows, field):
    return F.size(F.filter(rows, lambda r: r[field].isNotNull())).cast("long")


def origin_payload():
    """(delay, wind, weather-delay flag) of a flight, as later flights at its origin see it."""
    late = F.when(F.col("weather_delay_mins") > 0, 1).otherwise(0)
    return F.col("dep_delay_minutes"), F.col("wind_speed_knots"), late


def origin_history(keyed: DataFrame, narrow: DataFrame = None, carry=None) -> DataFrame:
    """Rolling delay, wind change and weather-delay flag of earlier flights at the origin."""
    delay, wind, late = origin_payload()
    payload = [delay.alias("delay"), wind.alias("wind"), late.alias("late")]
    features = {
        "_delay_sum": (
            6, lambda w: F.sum(delay).over(w.rowsBetween(-6, -1)),
            lambda here, rows: F.coalesce(here, F.lit(0.0)) + _total(rows, "delay")),
        "rolling_6_flight_origin_count": (
            6, lambda w: F.count(delay).over(w.rowsBetween(-6, -1)),
            lambda here, rows: here + _present(rows, "delay")),
        "_last_wind": (
            1, lambda w: F.lag(wind).over(w), lambda here, rows: F.get(rows, F.lit(0))["wind"]),
        "rolling_3_flight_weather_delay_flag": (
            3, lambda w: F.max(late).over(w.rowsBetween(-3, -1)),
            lambda here, rows: F.greatest(
                here, F.array_max(F.transform(rows, lambda r: r["late"])))),
    }
    return with_previous(keyed, DAY_ORDER, payload, features, narrow, carry).withColumns({
        "rolling_6_flight_origin_delay_avg": F.try_divide(
            "_delay_sum", "rolling_6_flight_origin_count"),
        "wind_speed_delta": wind - F.col("_last_wind"),
    }).drop("_delay_sum", "_last_wind")


def origin_rows(f: DataFrame, daily: DataFrame) -> DataFrame:
    """What the chain of an origin airport needs of each flight."""
    narrow = chunk_keys(
        f.select("date_id", *DAY_ORDER, "origin_airport_id", "dep_delay_minutes", "weather_delay_mins"),
        "origin_airport_id", "date_id")
    return _with_weather(narrow, daily)


def build_fact(flights: DataFrame, weather: DataFrame, null_tail_chain=True,
               carries=None) -> DataFrame:
    """Staged flights and staged weather to the 34-column feature fact.

    ``carries`` has stored carried rows by chain (see ``plans.upkeep``); flights and weather may
    then be any whole days of theirs.
    """
    f = flights.withColumnsRenamed(FACT_NAMES)
    daily = daily_weather(weather)
    carries = carries or {}

    chained = tail_lag(f, null_tail_chain, carries.get("aircraft"))
    hours = airport_hour(f)
    shifted = hour_history(hours, carries["hour"]) if "hour" in carries else prev_hour(hours)
    keyed = _with_weather(chunk_keys(join_prev_hour(chained, shifted), "origin_airport_id", "date_id"),
                          daily)
    narrow = None if "origin" in carries else origin_rows(f, daily)
    return origin_history(keyed, narrow, carries.get("origin")).select(*FACT_COLUMNS)


def model_input(fact: DataFrame, sample_pct=100) -> DataFrame:
    """Operated flights with the modelling names; a hash sample when below 100 %."""
    kept = fact.where((F.col("is_cancelled") == F.lit(False))
                      & F.col("dep_delay_minutes").isNotNull())
    if sample_pct < 100:
        kept = kept.where(C.hash_bucket("flight_id") < sample_pct)
    lagged = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in S.LAG_FEATURES]
    frame = kept.select(
        "flight_id", F.col("date_id").alias("flight_date"), "flight_month", "day_of_week",
        F.col("hour_id").alias("scheduled_dep_hour"), F.col("airline_id").alias("airline_code"),
        "tail_number", F.col("origin_airport_id").alias("Origin"),
        F.col("dest_airport_id").alias("Dest"), F.col("distance_miles").alias("Distance"),
        *[F.col(m).cast("double").alias(m) for m in WEATHER_MEASURES], *lagged,
        C.clamp("dep_delay_minutes", -S.DELAY_CAP, S.DELAY_CAP).alias("dep_delay_minutes"),
        "arr_delay_minutes", "weather_delay_mins")
    return frame.fillna(S.WEATHER_MEDIANS)
