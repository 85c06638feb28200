"""Schemas, column lists, thresholds and small code tables."""

from pyspark.sql import types as T

# --- Fixed values: input column lists ---------------------------------------

FLIGHT_COLUMNS = [
    "FlightDate", "Year", "Month", "DayofMonth", "Reporting_Airline",
    "Flight_Number_Reporting_Airline", "Tail_Number", "Origin", "Dest",
    "CRSDepTime", "DepTime", "DepDelay", "CRSArrTime", "ArrTime", "ArrDelay",
    "Cancelled", "CancellationCode", "Diverted", "AirTime", "Distance",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay",
]

MANUAL_FLIGHT_COLUMNS = [
    "FL_DATE", "YEAR", "MONTH", "DAY_OF_MONTH", "OP_UNIQUE_CARRIER",
    "OP_CARRIER_FL_NUM", "TAIL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME",
    "DEP_TIME", "DEP_DELAY", "CRS_ARR_TIME", "ARR_TIME", "ARR_DELAY",
    "CANCELLED", "CANCELLATION_CODE", "DIVERTED", "AIR_TIME", "DISTANCE",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY",
    "LATE_AIRCRAFT_DELAY",
]

AIRPORT_OPS_COLUMNS = [
    "Dep_YYYYMM", "Dep_DAY", "Dep_HOUR", "Dep_QTR",
    "Arr_YYYYMM", "Arr_DAY", "Arr_HOUR", "Arr_QTR",
    "Off_YYYYMM", "Off_DAY", "Off_HOUR", "Off_QTR",
    "On_YYYYMM", "On_DAY", "On_HOUR", "On_QTR",
    "Carrier", "Flight_Number", "Dep_Airport", "Arr_Airport",
    "DepSchDT", "DepSchTM", "ArrSchDT", "ArrSchTM", "ActTI", "ActTO",
    "AIRBORNE",
]

FACILITY_COLUMNS = [
    "Date", "Airport", "Facility", "State", "Region", "Service Area", "Class",
    "Local Hour", "Quarter Hour", "Arrival Operations",
    "Departure Operations", "Total Operations", "Delay Count",
    "Delay Minutes",
]

# Columns kept by the cleaning chain of the profiling study.
CLEAN_COLUMNS = [
    "FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline",
    "Origin", "Dest", "CRSDepTime", "DepTime", "DepDelay", "DepDelayMinutes",
    "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "Cancelled",
    "CancellationCode", "WeatherDelay", "NASDelay", "CarrierDelay",
    "SecurityDelay", "LateAircraftDelay", "DayOfWeek", "Month", "Distance",
    "TaxiOut", "TaxiIn",
]

# Columns of the small flight sample, which also keeps the aircraft.
SAMPLE_COLUMNS = CLEAN_COLUMNS + ["Tail_Number"]

SCORE_COLUMNS = [
    "flight_date", "airline_code", "Origin", "Dest", "scheduled_dep_hour",
    "Distance", "dep_delay_minutes", "arr_delay_minutes", "is_delayed",
    "risk_score", "risk_label", "rolling_6_flight_origin_delay_avg",
    "lag_1_tail_arr_delay_mins", "wind_speed_knots", "temperature_c",
    "precipitation_mm", "cloud_cover_total_pct", "origin_pagerank",
    "origin_betweenness", "flight_month", "day_of_week",
    "weather_delay_mins",
]

FEATURE_COLUMNS = [
    "flight_month", "day_of_week", "scheduled_dep_hour", "Distance",
    "temperature_c", "precipitation_mm", "wind_speed_knots",
    "cloud_cover_total_pct", "cloud_cover_low_pct",
    "rolling_6_flight_origin_delay_avg",
    "rolling_3_flight_weather_delay_flag", "wind_speed_delta",
    "lag_1_tail_arr_delay_mins", "dest_prev_hour_delay_avg",
    "dest_prev_hour_flight_count", "origin_pagerank", "origin_betweenness",
    "dest_pagerank", "dest_betweenness",
]

SNAPSHOT_CHECK_COLUMNS = [
    "dep_delay_minutes", "arr_delay_minutes", "weather_delay_mins",
    "temperature_c", "wind_speed_knots",
]

# Types of the raw flight table; columns not named here are text.
FLIGHT_TYPES = {
    "year": "int", "month": "int", "dayofmonth": "int",
    "flight_number_reporting_airline": "long", "crsdeptime": "int", "deptime": "double",
    "depdelay": "double", "crsarrtime": "int", "arrtime": "double", "arrdelay": "double",
    "cancelled": "double", "diverted": "double", "airtime": "double", "distance": "double",
    "carrierdelay": "double", "weatherdelay": "double", "nasdelay": "double",
    "securitydelay": "double", "lateaircraftdelay": "double",
}

CAUSE_COLUMNS = {
    "carrierdelay": "Carrier", "weatherdelay": "Weather", "nasdelay": "NAS",
    "securitydelay": "Security", "lateaircraftdelay": "Late Aircraft",
}

WEATHER_FEATURES = [
    "wind_speed_knots", "precipitation_mm", "temperature_c",
    "cloud_cover_total_pct", "cloud_cover_low_pct", "wind_speed_delta",
    "rolling_3_flight_weather_delay_flag",
]
WEATHER_FLAG = "rolling_3_flight_weather_delay_flag"
WEATHER_FLAG_LABEL = "Recent weather delay (rolling 3-flight flag)"

# --- Fixed values: thresholds and constants ---------------------------------

DELAY_THRESHOLD = 15
DELAY_CAP = 720
EARTH_RADIUS_MILES = 3958.8
DEFAULT_DISTANCE_MILES = 679.0
RISK_LOW, RISK_HIGH = 0.3, 0.6

WEATHER_MEDIANS = {
    "temperature_c": 24.50,
    "precipitation_mm": 0.00,
    "wind_speed_knots": 5.00,
    "cloud_cover_total_pct": 22.00,
    "cloud_cover_low_pct": 0.00,
}

LAG_FEATURES = [
    "lag_1_tail_arr_delay_mins", "rolling_6_flight_origin_delay_avg",
    "wind_speed_delta", "rolling_3_flight_weather_delay_flag",
    "dest_prev_hour_delay_avg", "dest_prev_hour_flight_count",
]

BIN_EDGES = {
    "wind_speed_knots": [0, 3, 6, 9, 12, 15, 18, 22, 26, 30, 40, 60],
    "precipitation_mm": [-0.01, 0.01, 0.5, 1.5, 3, 5, 8, 12, 20, 40, 100],
    "cloud_cover_total_pct": [-0.01, 10, 25, 40, 55, 70, 85, 100],
    "temperature_c": [-30, -15, -5, 5, 15, 22, 28, 34, 40, 50],
}

WIND_BAND_EDGES = [0, 5, 10, 15, 20, 30, 60]
WIND_BAND_LABELS = ["0-5", "5-10", "10-15", "15-20", "20-30", "30+"]

QUADRANTS = {
    (True, True): "High Risk (Important + Delayed)",
    (False, True): "Unreliable (Low Importance + Delayed)",
    (True, False): "Safe Hub (Important + On-Time)",
    (False, False): "Low Priority (Low Importance + On-Time)",
}

# --- Fixed values: provenance labels and weather source priority -------------

FLIGHT_SOURCE, AIRPORT_OPS_SOURCE, FACILITY_SOURCE = "bts", "aspm", "opsnet"
ARCHIVE_SOURCE, OBSERVATION_SOURCE, FORECAST_SOURCE = "openmeteo", "awc_metar", "awc_taf"
RAW_STAGE = "raw"
WEATHER_PRIORITY = {"metar": 1, "openmeteo": 2, "taf": 3}

# --- Fixed values: small code tables ----------------------------------------

CANCELLATION_LABELS = {
    "A": "Carrier", "B": "Weather", "C": "NAS / ATC", "D": "Security",
}

STATION_TO_AIRPORT = {
    "KATL": "ATL", "KDFW": "DFW", "KDEN": "DEN", "KORD": "ORD",
    "KLAX": "LAX", "KJFK": "JFK", "KSFO": "SFO", "KSEA": "SEA",
    "KLAS": "LAS", "KMCO": "MCO",
}

FEATURE_LABELS = {
    "lag_1_tail_arr_delay_mins": "Prev. arrival delay (mins)",
    "scheduled_dep_hour": "Departure hour",
    "rolling_6_flight_origin_delay_avg": "Origin delay avg (last 6 flights)",
    "origin_pagerank": "Origin airport PageRank",
    "dest_pagerank": "Destination airport PageRank",
    "Distance": "Flight distance",
    "origin_betweenness": "Origin betweenness centrality",
    "rolling_3_flight_weather_delay_flag": "Recent weather delay flag",
    "flight_month": "Month of year",
    "temperature_c": "Temperature (°C)",
    "day_of_week": "Day of week",
    "precipitation_mm": "Precipitation (mm)",
    "cloud_cover_total_pct": "Total cloud cover (%)",
    "wind_speed_knots": "Wind speed (knots)",
    "cloud_cover_low_pct": "Low cloud cover (%)",
    "wind_speed_delta": "Wind speed change",
    "dest_prev_hour_delay_avg": "Destination delay avg (prev hour)",
    "dest_prev_hour_flight_count": "Destination flight count (prev hour)",
    "dest_betweenness": "Destination betweenness centrality",
}

WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]

# --- Declared input schemas --------------------------------------------------

_ARCHIVE_MEASURES = {
    "temperature_2m": T.DoubleType(), "relative_humidity_2m": T.LongType(),
    "precipitation": T.DoubleType(), "visibility": T.DoubleType(),
    "wind_speed_10m": T.DoubleType(), "weather_code": T.LongType(),
    "cloud_cover": T.LongType(), "cloud_cover_low": T.LongType(),
}

ARCHIVE_SCHEMA = T.StructType([
    T.StructField("airport_code", T.StringType()),
    T.StructField("extract_start_date", T.StringType()),
    T.StructField("extract_end_date", T.StringType()),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(n, T.ArrayType(t)) for n, t in _ARCHIVE_MEASURES.items()]
    )),
])

OBSERVATION_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in {
        "icaoId": T.StringType(), "reportTime": T.StringType(),
        "receiptTime": T.StringType(), "temp": T.DoubleType(),
        "dewp": T.DoubleType(), "wdir": T.StringType(),
        "wspd": T.DoubleType(), "wgst": T.DoubleType(),
        "visib": T.StringType(), "altim": T.DoubleType(),
        "slp": T.DoubleType(), "fltCat": T.StringType(),
        "cover": T.StringType(), "metarType": T.StringType(),
        "rawOb": T.StringType(), "lat": T.DoubleType(),
        "lon": T.DoubleType(), "elev": T.DoubleType(),
        "ingested_at": T.StringType(),
    }.items()
])

FORECAST_PERIOD = T.StructType([
    T.StructField(n, t) for n, t in {
        "timeFrom": T.StringType(), "timeTo": T.StringType(),
        "fcstChange": T.StringType(), "wdir": T.StringType(),
        "wspd": T.DoubleType(), "wgst": T.DoubleType(),
        "visib": T.StringType(), "wxString": T.StringType(),
        "fltCat": T.StringType(),
    }.items()
])

FORECAST_SCHEMA = T.StructType([
    T.StructField("icaoId", T.StringType()),
    T.StructField("issueTime", T.StringType()),
    T.StructField("bulletinTime", T.StringType()),
    T.StructField("rawTAF", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("fcsts", T.ArrayType(FORECAST_PERIOD)),
    T.StructField("ingested_at", T.StringType()),
])
