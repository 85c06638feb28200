"""Equi-joins of flights with weather, congestion, centrality and dimensions.

Small sides carry no broadcast hint: the optimizer broadcasts what is below
its size threshold (at run time too) and shuffles otherwise.
"""

from pyspark.sql import DataFrame, functions as F

from delaylens.functions import columns as C

WEATHER_MEASURES = ["temperature_c", "precipitation_mm", "wind_speed_knots",
                    "cloud_cover_total_pct", "cloud_cover_low_pct"]


def join_weather(flights: DataFrame, weather: DataFrame, origin="origin_airport",
                 date="flight_date", hour="scheduled_dep_hour") -> DataFrame:
    """Weather of the origin airport at the scheduled date and hour, NULL when unmatched."""
    w = weather.select(F.col("airport_id").alias("_wa"), F.col("date_id").alias("_wd"),
                       F.col("hour_id").alias("_wh"), *WEATHER_MEASURES)
    on = ((F.col(origin) == F.col("_wa")) & (F.col(date) == F.col("_wd"))
          & (F.col(hour) == F.col("_wh")))
    return flights.join(w, on, "left").drop("_wa", "_wd", "_wh")


def join_prev_hour(flights: DataFrame, shifted: DataFrame) -> DataFrame:
    """Previous-hour conditions of the destination airport."""
    d = shifted.select(
        F.col("airport_id").alias("_da"), F.col("date_id").alias("_dd"),
        F.col("hour_id").alias("_dh"),
        F.col("prev_hour_delay_avg").alias("dest_prev_hour_delay_avg"),
        F.col("prev_hour_flight_count").alias("dest_prev_hour_flight_count"))
    on = ((F.col("dest_airport_id") == F.col("_da")) & (F.col("date_id") == F.col("_dd"))
          & (F.col("hour_id") == F.col("_dh")))
    return flights.join(d, on, "left").drop("_da", "_dd", "_dh")


def match_rate(joined: DataFrame, probe="temperature_c") -> DataFrame:
    return joined.agg(
        F.count(probe).alias("matched"), F.count(F.lit(1)).alias("total"),
        (F.try_divide(F.count(probe), F.count(F.lit(1))) * 100).alias("matched_pct"))


def add_centrality(flights: DataFrame, centrality: DataFrame, origin="Origin",
                   dest="Dest") -> DataFrame:
    """PageRank and betweenness of both endpoints, 0 for unknown airports."""
    out = flights
    for side, key in (("origin", origin), ("dest", dest)):
        c = centrality.select(F.col("airport").alias("_a"),
                              F.col("pagerank").alias(f"{side}_pagerank"),
                              F.col("betweenness").alias(f"{side}_betweenness"))
        out = out.join(c, F.col(key) == F.col("_a"), "left").drop("_a")
    return out.fillna(0.0, ["origin_pagerank", "origin_betweenness",
                            "dest_pagerank", "dest_betweenness"])


def with_coords(airports: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach lat / lon; airports without coordinates are left out."""
    known = dimension.select("airport", "lat", "lon").dropna()
    return airports.join(known, "airport")


def with_label(df: DataFrame, code, dimension: DataFrame, label, keep_unknown=True) -> DataFrame:
    """Label of a code from a (code, label) table; the code itself, or no row, when unknown."""
    d = dimension.toDF("_code", "_label")
    out = df.join(d, F.col(code) == F.col("_code"), "left" if keep_unknown else "inner")
    return out.withColumn(label, F.coalesce("_label", F.col(code))).drop("_code", "_label")


def code_table(spark, names: dict) -> DataFrame:
    """A literal table; the hint holds for the few codes of a Python dict only."""
    return F.broadcast(spark.createDataFrame(list(names.items()), "code string, label string"))


def airport_delay(flights: DataFrame, centrality: DataFrame, min_n=300) -> DataFrame:
    """Delay rate and count of airports with enough flights, with their centrality."""
    return _airport_rates(flights, min_n).join(centrality, "airport")


def _airport_rates(flights, min_n):
    return (flights.groupBy(F.col("Origin").alias("airport"))
            .agg(F.avg("is_delayed").alias("delay_rate"), F.count("is_delayed").alias("count"))
            .where(F.col("count") >= min_n))


def with_delay_rate(airports: DataFrame, flights: DataFrame, min_n=100) -> DataFrame:
    rates = _airport_rates(flights, min_n).select("airport", "delay_rate")
    return airports.join(rates, "airport", "left").fillna(0.0, ["delay_rate"])


def routes_within(routes: DataFrame, airports: DataFrame, src="Origin", dest="Dest") -> DataFrame:
    """Routes with both ends in the airport set."""
    known = airports.select("airport").distinct()
    return (routes.join(known.withColumnRenamed("airport", src), src, "left_semi")
            .join(known.withColumnRenamed("airport", dest), dest, "left_semi"))


def endpoint_airports(airports: DataFrame, routes: DataFrame, src="Origin",
                      dest="Dest") -> DataFrame:
    """Airports that are an end of some route."""
    ends = routes.select(F.explode(F.array(src, dest)).alias("airport")).distinct()
    return airports.join(ends, "airport", "left_semi")


def distances(routes: DataFrame, dimension: DataFrame, src="Origin", dest="Dest",
              **kw) -> DataFrame:
    """Great-circle miles for each route, the default where an airport is unknown."""
    out = routes
    for side, key in (("_o", src), ("_d", dest)):
        place = dimension.select(F.col("airport").alias(side), F.col("lat").alias(f"{side}lat"),
                                 F.col("lon").alias(f"{side}lon"))
        out = out.join(place, F.col(key) == F.col(side), "left")
    miles = C.haversine_miles("_olat", "_olon", "_dlat", "_dlon", **kw)
    return out.withColumn("miles", miles).drop("_o", "_olat", "_olon", "_d", "_dlat", "_dlon")
