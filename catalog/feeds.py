"""Streaming feeds: events land as JSON files in several polls, then stream through."""

from pyspark.sql import functions as F

from catalog import base
from catalog.base import query, with_tables
from catalog.landing import (
    FORECAST_COLUMNS, FORECASTS, STATION_COLUMNS, STATIONS, forecast_docs, station_reports,
)
from delaylens.plans import staging
from delaylens.session import scratch
from delaylens.streaming import feeds, windows


#: Files of one poll, and files per batch: every stream runs over several batches.
POLLS, FILES = 3, 2


def _polls(docs, label):
    """All documents twice in one landing folder of at least six files."""
    path = scratch(docs.sparkSession, label)
    for _ in range(2):
        docs.repartition(POLLS).write.mode("append").json(path)
    return path


def _run(stream_query):
    stream_query.awaitTermination()


@query("streamed_observations", with_tables(extra=STATIONS, body=f"""
SELECT {', '.join(STATION_COLUMNS)} FROM (SELECT * FROM stations UNION ALL SELECT * FROM stations)
"""))
def streamed_observations(spark, sf):
    landing, target = _polls(station_reports(spark, sf), "polls"), scratch(spark, "observed")
    _run(feeds.ingest_observations(spark, landing, target, scratch(spark, "offsets"), FILES))
    return spark.read.parquet(target).select(*STATION_COLUMNS)


@query("streamed_forecasts", with_tables(extra=FORECASTS, body="SELECT * FROM periods"))
def streamed_forecasts(spark, sf):
    landing, target = scratch(spark, "bulletins"), scratch(spark, "forecast")
    forecast_docs(spark, sf).repartition(2 * POLLS).write.json(landing)
    _run(feeds.ingest_forecasts(spark, landing, target, scratch(spark, "offsets"), FILES))
    return spark.read.parquet(target).select(*FORECAST_COLUMNS)


@query("streamed_without_repeats", with_tables(extra=STATIONS, body="""
SELECT icao_id, obs_time, count(*) OVER () AS total FROM (
  SELECT DISTINCT icao_id, obs_time FROM stations)"""))
def streamed_without_repeats(spark, sf):
    """Every distinct report once, those without a readable time too."""
    landing, target = _polls(station_reports(spark, sf), "polls"), scratch(spark, "distinct")
    _run(feeds.ingest_distinct(spark, landing, target, scratch(spark, "offsets"), FILES))
    kept = spark.read.parquet(target).select("icao_id", "obs_time")
    return kept.withColumn("total", kept.agg(F.count(F.lit(1))).scalar())


@query("streamed_latest_state", with_tables(extra=STATIONS, body=f"""
SELECT {', '.join(STATION_COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY iata_code
    ORDER BY ingested_at DESC, obs_time DESC, temp_c DESC, wind_speed_knots DESC) AS rn
  FROM stations) WHERE rn = 1"""))
def streamed_latest_state(spark, sf):
    landing, state = _polls(station_reports(spark, sf), "polls"), scratch(spark, "state")
    _run(feeds.latest_state(feeds.observations(spark, landing, FILES), state, scratch(spark, "offsets")))
    return feeds.read_state(spark, state).select(*STATION_COLUMNS)


@query("streamed_airport_hours", with_tables("stg_weather", body="""
SELECT airport_id, date_id, hour_id, temperature_c, precipitation_mm, wind_speed_knots,
  cloud_cover_total_pct, cloud_cover_low_pct FROM stg_weather"""))
def streamed_airport_hours(spark, sf):
    """Archive rows first, then forecasts, then observations replace them hour by hour."""
    archive, observations, forecasts = base.weather_feeds(spark, sf)
    table = scratch(spark, "hours")
    shapes = [(archive, staging.archive_hours), (forecasts, staging.forecast_hours),
              (observations, staging.observation_hours)]
    for rows, shape in shapes:
        landing = scratch(spark, "feed")
        rows.repartition(POLLS).write.json(landing)
        stream = (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
                  .json(landing))
        _run(feeds.stream_airport_hours(shape(stream), table, scratch(spark, "offsets")))
    return spark.read.parquet(table).select(
        "airport_id", "date_id", "hour_id", "temperature_c", "precipitation_mm",
        "wind_speed_knots", "cloud_cover_total_pct", "cloud_cover_low_pct")


#: Every report of the month counts, whatever the order of the files.
MONTH_LATE = "60 days"


def _observed(spark, landing):
    return feeds.observations(spark, landing, FILES)


@query("streamed_hourly_reports", with_tables(extra=STATIONS, body="""
SELECT iata_code, strftime(date_trunc('hour', CAST(obs_time AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S')
    AS hour_start, count(*) AS reports, round(avg(temp_c), 6) AS mean_temp_c,
  max(wind_speed_knots) AS max_wind_knots
FROM (SELECT * FROM stations UNION ALL SELECT * FROM stations) WHERE obs_time <> 'unreadable'
GROUP BY ALL"""))
def streamed_hourly_reports(spark, sf):
    """Airport-hours by event time, kept up to date over several batches."""
    landing, table = _polls(station_reports(spark, sf), "polls"), scratch(spark, "hourly")
    _run(windows.keep_updated(windows.hourly(_observed(spark, landing), MONTH_LATE), table,
                              scratch(spark, "offsets")))
    return spark.read.parquet(table).select(
        "iata_code", F.date_format("hour_start", "yyyy-MM-dd HH:mm:ss").alias("hour_start"), "reports",
        F.round("mean_temp_c", 6).alias("mean_temp_c"), "max_wind_knots")


@query("streamed_report_sessions", with_tables(extra={**STATIONS, "marked": (["stations"], """
    SELECT iata_code, t, CASE WHEN t > lag(t) OVER w + INTERVAL 3 HOUR OR lag(t) OVER w IS NULL
      THEN 1 ELSE 0 END AS begins
    FROM (SELECT iata_code, CAST(obs_time AS TIMESTAMP) AS t FROM stations
      WHERE obs_time <> 'unreadable') WINDOW w AS (PARTITION BY iata_code ORDER BY t)"""),
    "numbered": (["marked"], """SELECT *, sum(begins) OVER (PARTITION BY iata_code ORDER BY t
      ROWS UNBOUNDED PRECEDING) AS session FROM marked""")}, body="""
SELECT iata_code, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first_report,
  strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last_report, count(*) AS reports
FROM numbered GROUP BY iata_code, session"""))
def streamed_report_sessions(spark, sf):
    """Sessions of every airport; a report from the year after closes the last ones."""
    landing, target = scratch(spark, "polls"), scratch(spark, "sessions")
    reports = station_reports(spark, sf)
    reports.repartition(POLLS).write.json(landing)
    reports.orderBy("ingested_at").limit(1).withColumn(
        "reportTime", F.lit("2099-01-01T00:00:00")).write.mode("append").json(landing)
    _run(windows.keep_closed(windows.sessions(_observed(spark, landing), delay=MONTH_LATE), target,
                             scratch(spark, "offsets")))
    return spark.read.parquet(target).select(
        "iata_code", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
                       for c in ("first_report", "last_report")], "reports")
