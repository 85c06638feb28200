"""File sources and table sinks: events are written as files by Spark, then read back."""

from pyspark.sql import functions as F, types as T

from catalog import base
from catalog.base import query, with_tables
from catalog.network import HUBS
from catalog.reports import rounded
from delaylens import schemas as S
from delaylens.session import scratch
from delaylens.sources import archives, delimited, layout, tables, weather, zipped


def _landed(df, label, fmt="csv", **options):
    path = scratch(df.sparkSession, label)
    df.write.options(**options).format(fmt).save(path)
    return path


def _manual(spark, sf):
    return base.ontime(spark, sf).select(
        F.col("flightdate").alias("FL_DATE"), F.col("year").alias("YEAR"),
        F.col("reporting_airline").alias("OP_UNIQUE_CARRIER"),
        F.col("flight_number_reporting_airline").alias("OP_CARRIER_FL_NUM"),
        F.col("origin").alias("ORIGIN"), F.col("dest").alias("DEST"),
        F.col("crsdeptime").alias("CRS_DEP_TIME"), F.col("depdelay").alias("DEP_DELAY"),
        F.lit("x").alias("NOT_WANTED"))


MANUAL = """flightdate AS fl_date, CAST(year AS VARCHAR) AS year,
  reporting_airline AS op_unique_carrier,
  CAST(flight_number_reporting_airline AS VARCHAR) AS op_carrier_fl_num, origin, dest,
  CAST(crsdeptime AS VARCHAR) AS crs_dep_time, CAST(CAST(depdelay AS DOUBLE) AS VARCHAR)
  AS dep_delay, 'bts' AS source_name, 'raw' AS ingestion_stage"""


@query("flights_from_csv", with_tables("ontime", body=f"SELECT {MANUAL} FROM ontime"))
def flights_from_csv(spark, sf):
    path = _landed(_manual(spark, sf), "flights.csv", header=True)
    return delimited.read_flights_csv(spark, path).drop("source_file")


@query("flights_from_unknown_separator", with_tables("ontime", body=f"""
SELECT {MANUAL} FROM ontime"""))
def flights_from_unknown_separator(spark, sf):
    path = _landed(_manual(spark, sf), "flights-txt", header=True, sep="\t")
    return delimited.read_flights_csv(spark, path).drop("source_file")


@query("flights_from_mixed_headers", with_tables("ontime", body=f"""
SELECT {MANUAL.replace("CAST(CAST(depdelay AS DOUBLE) AS VARCHAR)", """CASE WHEN
    flight_number_reporting_airline % 3 < 2 THEN CAST(CAST(depdelay AS DOUBLE) AS VARCHAR) END""")}
FROM ontime"""))
def flights_from_mixed_headers(spark, sf):
    """Three layouts in one folder: another order, another separator, a column less."""
    rows, folder = _manual(spark, sf), scratch(spark, "mixed")
    kind = F.col("OP_CARRIER_FL_NUM") % 3
    layouts = [(rows, ",", ".csv"), (rows.select(*reversed(rows.columns)), "|", ".txt"),
               (rows.drop("DEP_DELAY", "NOT_WANTED"), "\t", ".txt")]
    for k, (layout, sep, end) in enumerate(layouts):
        layout.where(kind == k).write.mode("append").option("extension", end[1:]).csv(
            folder, header=True, sep=sep)
    return delimited.read_mixed_flights(spark, folder).drop("source_file")


@query("airport_operations", with_tables("ontime", body="""
SELECT CAST(dayofmonth AS VARCHAR) AS dep_day, CAST(crsdeptime // 100 AS VARCHAR) AS dep_hour,
  reporting_airline AS carrier, CAST(flight_number_reporting_airline AS VARCHAR) AS flight_number,
  origin AS dep_airport, CASE WHEN reporting_airline IN ('view', 'click') THEN dest END
    AS arr_airport, 'aspm' AS source_name, 'raw' AS ingestion_stage FROM ontime"""))
def airport_operations(spark, sf):
    """Comma and tab files with different columns in one table."""
    f = base.ontime(spark, sf)
    shown = [F.col("dayofmonth").alias("Dep_DAY"), F.floor(F.col("crsdeptime") / 100)
             .alias("Dep_HOUR"), F.col("reporting_airline").alias("Carrier"),
             F.col("flight_number_reporting_airline").alias("Flight_Number"),
             F.col("origin").alias("Dep_Airport")]
    some = F.col("reporting_airline").isin("view", "click")
    comma = _landed(f.where(some).select(*shown, F.col("dest").alias("Arr_Airport")),
                    "ops.csv", header=True)
    tab = _landed(f.where(~some).select(*shown), "ops.tsv", header=True, sep="\t")
    # a folder's separator follows its name or, failing that, its header line
    return delimited.read_airport_ops(spark, [comma, tab]).drop("source_file")


@query("facility_counts", with_tables("ontime", body="""
SELECT flightdate AS date, origin AS airport, CAST(crsdeptime // 100 AS VARCHAR) AS local_hour,
  CAST(count(*) AS VARCHAR) AS total_operations,
  CAST(count(*) FILTER (WHERE depdelay > 15) AS VARCHAR) AS delay_count,
  'opsnet' AS source_name, 'raw' AS ingestion_stage FROM ontime GROUP BY 1, 2, 3"""))
def facility_counts(spark, sf):
    return delimited.read_facility_counts(
        spark, _landed(_facility(spark, sf), "facility.csv", header=True)).drop("source_file")


def _facility(spark, sf):
    return (base.ontime(spark, sf)
            .groupBy(F.col("flightdate").alias("Date"), F.col("origin").alias("Airport"),
                     F.floor(F.col("crsdeptime") / 100).alias("Local Hour"))
            .agg(F.count(F.lit(1)).alias("Total Operations"),
                 F.count_if(F.col("depdelay") > 15).alias("Delay Count")))


@query("facility_counts_from_html", with_tables("ontime", body="""
SELECT flightdate AS date, origin AS airport, CAST(crsdeptime // 100 AS VARCHAR) AS local_hour,
  CAST(count(*) AS VARCHAR) AS total_operations,
  CAST(count(*) FILTER (WHERE depdelay > 15) AS VARCHAR) AS delay_count,
  'opsnet' AS source_name, 'raw' AS ingestion_stage FROM ontime GROUP BY 1, 2, 3"""))
def facility_counts_from_html(spark, sf):
    """One HTML table per day; odd days have a three-level header, even days another order."""
    def line(*names):
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.col(c).cast("string"),
                                                  F.lit("</td>")) for c in names],
                        F.lit("<td></td></tr>"))

    odd = F.dayofmonth(F.col("Date").cast("date")) % 2 == 1
    row = F.when(odd, line("Date", "Airport", "Local Hour", "Total Operations", "Delay Count")
                 ).otherwise(line("Airport", "Delay Count", "Date", "Total Operations", "Local Hour"))
    other = ("<html><table><tr><th>Airport</th><th>Delay Count</th><th>Date</th>"
             "<th>Total Operations</th><th>Local Hour</th><th>Notes</th></tr>")
    head = ("<html><table><tr><th colspan='3'>Where</th><th colspan='3'>Counts</th></tr>"
            "<tr><th rowspan='2'>Date</th><th rowspan='2'>Airport</th><th>Local</th>"
            "<th>Total</th><th>Delays</th><th></th></tr>"
            "<tr><th>Local Hour</th><th>Total Operations</th><th>Delay Count</th><th>Notes</th>"
            "</tr>")
    # at most airports x 24 hours per table
    pages = _facility(spark, sf).groupBy("Date").agg(
        F.concat_ws("", F.collect_list(row)).alias("rows"))
    html = pages.select(
        F.concat(F.when(odd, head).otherwise(other), F.col("rows"), F.lit("</table></html>"))
        .alias("value"),
        F.col("Date").alias("file"))
    path = scratch(spark, "facility-html")
    html.repartition("file").write.partitionBy("file").text(path)
    return delimited.read_html_rows(spark, f"{path}/*").drop("source_file")


@query("flights_from_zip", with_tables("ontime", body="""
SELECT flightdate, reporting_airline, flight_number_reporting_airline, origin, dest, crsdeptime,
  'bts' AS source_name, 'raw' AS ingestion_stage FROM ontime"""))
def flights_from_zip(spark, sf):
    files = _archives(spark, sf)
    names = ["FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin",
             "Dest", "CRSDepTime"]
    rows, _ = archives.split_archives(archives.unzip_csv(files, names))
    return rows


ZIPPED = ["FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest",
          "CRSDepTime"]
ZIPPED_SQL = """SELECT flightdate, reporting_airline, flight_number_reporting_airline, origin, dest,
  crsdeptime, 'bts' AS source_name, 'raw' AS ingestion_stage FROM ontime"""


def _landed_archives(spark, sf):
    """Archives as files of a shared folder, written by the tasks that pack them."""
    folder = scratch(spark, "zips")

    def save(pdf):
        from pyarrow import fs
        system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(base)
        for name, content in zip(pdf["path"], pdf["content"]):
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(content)
        return pdf[["path"]]

    packed = _archives(spark, sf)
    packed.groupBy("path").applyInPandas(save, "path string").count()
    return folder


@query("flights_from_zipped_source", with_tables("ontime", body=ZIPPED_SQL))
def flights_from_zipped_source(spark, sf):
    """Archives through the data source: a partition for each member, no archive in memory."""
    return zipped.read_zipped(spark, _landed_archives(spark, sf), ZIPPED)[0]


@query("streamed_zipped_flights", with_tables("ontime", body=ZIPPED_SQL))
def streamed_zipped_flights(spark, sf):
    """The same archives as a stream; a second call finds nothing new."""
    folder, table = _landed_archives(spark, sf), scratch(spark, "zipped")
    rejects, log = scratch(spark, "rejects"), scratch(spark, "log")
    for _ in range(2):
        zipped.ingest_zipped(spark, folder, table, rejects, log, ZIPPED)
    return spark.read.parquet(table).drop("batch")


def _archives(spark, sf, rows_per_archive=5000):
    """Archives of at most 5000 flights each, packed by the tasks."""
    f = base.ontime(spark, sf)
    number = F.col("flight_number_reporting_airline")
    wanted = f.select(
        F.floor(number / rows_per_archive).alias("part"), F.col("flightdate").alias("FlightDate"),
        F.col("reporting_airline").alias("Reporting_Airline"),
        number.alias("Flight_Number_Reporting_Airline"), F.col("origin").alias("Origin"),
        F.col("dest").alias("Dest"), F.col("crsdeptime").alias("CRSDepTime"),
        F.lit("junk").alias("Junk"))

    def pack(pdf):
        import io
        import zipfile

        import pandas as pd
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.html", "about")
            z.writestr("flights.csv", pdf.drop(columns="part").to_csv(index=False))
        return pd.DataFrame({"path": [f"{pdf['part'].iloc[0]}.zip"], "content": [body.getvalue()]})

    return wanted.groupBy("part").applyInPandas(pack, "path string, content binary")


def _archive_docs(spark, sf, rows_per_doc=1000):
    """Documents of parallel arrays per airport and day, at most 1000 readings each."""
    k = F.col("k")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    row = F.struct(
        stamp.alias("time"), (F.col("value") - 20).alias("temperature_2m"),
        (F.col("value") / 50).alias("precipitation"),
        (k % 40).cast("double").alias("wind_speed_10m"), k.cast("long").alias("cloud_cover"),
        F.floor(k / 2).cast("long").alias("cloud_cover_low"))
    docs = base.events(spark, sf).groupBy(
        F.concat(F.lit("A"), F.lpad((k % 25).cast("string"), 2, "0")).alias("airport_code"),
        F.date_format("ts", "yyyy-MM-dd").alias("extract_start_date"),
        F.floor(F.col("event_id") / rows_per_doc).alias("part")).agg(
        F.collect_list(row).alias("r"))
    return docs.select(
        "airport_code", "extract_start_date", F.col("extract_start_date").alias("extract_end_date"),
        F.struct(*[F.col("r")[c].alias(c) for c in (
            "time", "temperature_2m", "precipitation", "wind_speed_10m", "cloud_cover",
            "cloud_cover_low")]).alias("hourly"))


@query("hourly_archive_from_json", with_tables("archive_all", body="""
SELECT airport_code, strftime(t, '%Y-%m-%dT%H:%M:%S') AS time, temperature_2m, precipitation,
  wind_speed_10m, cloud_cover, cloud_cover_low, CAST(NULL AS BIGINT) AS relative_humidity_2m,
  CAST(NULL AS DOUBLE) AS visibility, CAST(NULL AS BIGINT) AS weather_code,
  strftime(t, '%Y-%m-%d') AS extract_start_date, strftime(t, '%Y-%m-%d') AS extract_end_date,
  'openmeteo' AS source_name FROM archive_all"""))
def hourly_archive_from_json(spark, sf):
    path = _landed(_archive_docs(spark, sf), "archive-json", "json")
    return weather.explode_hourly(weather.read_json(spark, path, S.ARCHIVE_SCHEMA, False))


CATEGORIES, COVERS = ["VFR", "MVFR", "IFR", "LIFR"], ["CLR", "FEW", "SCT", "BKN", "OVC"]


def _one_of(names, k):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (k % len(names) + 1).cast("int"))


def station_reports(spark, sf):
    """Events as station reports."""
    k = F.col("k")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    stations = list(S.STATION_TO_AIRPORT)
    known = F.element_at(F.array(*[F.lit(s) for s in stations]), (k % 10 + 1).cast("int"))
    return base.events(spark, sf).select(
        F.when(k < 50, known).otherwise(F.concat(F.lit("K"), F.lpad((k % 25).cast("string"), 3, "0")))
        .alias("icaoId"),
        F.when(k == 55, F.lit("unreadable")).otherwise(stamp).alias("reportTime"),
        stamp.alias("receiptTime"), (F.col("value") - 20).alias("temp"),
        F.when(k % 6 != 0, F.col("value") - 25).alias("dewp"),
        F.when(k % 7 == 0, F.lit("VRB")).otherwise((k * 3).cast("string")).alias("wdir"),
        (k % 40).cast("double").alias("wspd"),
        F.when(k % 3 == 0, (k % 40 + 10).cast("double")).alias("wgst"),
        F.concat((k % 10).cast("string"), F.lit("+")).alias("visib"),
        (990.5 + k % 50).alias("altim"), F.when(k % 8 != 0, 991.25 + k % 50).alias("slp"),
        _one_of(CATEGORIES, k).alias("fltCat"), _one_of(COVERS, k).alias("cover"),
        F.when(k % 2 == 0, F.lit("METAR")).otherwise(F.lit("SPECI")).alias("metarType"),
        F.concat(F.lit("METAR "), F.col("event_id").cast("string")).alias("rawOb"),
        (25 + k % 25).cast("double").alias("lat"), (k % 50 - 120).cast("double").alias("lon"),
        (k * 10).cast("double").alias("elev"), stamp.alias("ingested_at"))


STATIONS = {"rep": (["ev"], """SELECT CASE WHEN k < 50 THEN (['KATL', 'KDFW', 'KDEN', 'KORD',
      'KLAX', 'KJFK', 'KSFO', 'KSEA', 'KLAS', 'KMCO'])[k % 10 + 1]
      ELSE 'K' || lpad(CAST(k % 25 AS VARCHAR), 3, '0') END AS icao_id,
    CASE WHEN k = 55 THEN 'unreadable' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS obs_time,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS receipt_time, value - 20 AS temp_c,
    CASE WHEN k % 6 <> 0 THEN value - 25 END AS dewpoint_c,
    CASE WHEN k % 7 = 0 THEN 'VRB' ELSE CAST(k * 3 AS VARCHAR) END AS wind_dir_deg,
    CAST(k % 40 AS DOUBLE) AS wind_speed_knots,
    CASE WHEN k % 3 = 0 THEN CAST(k % 40 + 10 AS DOUBLE) END AS wind_gust_knots,
    CAST(k % 10 AS VARCHAR) || '+' AS visibility_sm,
    CAST(990.5 + k % 50 AS DOUBLE) AS altimeter_hpa,
    CASE WHEN k % 8 <> 0 THEN CAST(991.25 + k % 50 AS DOUBLE) END AS sea_level_pres_hpa,
    (['VFR', 'MVFR', 'IFR', 'LIFR'])[k % 4 + 1] AS flight_category,
    (['CLR', 'FEW', 'SCT', 'BKN', 'OVC'])[k % 5 + 1] AS cloud_cover,
    CASE WHEN k % 2 = 0 THEN 'METAR' ELSE 'SPECI' END AS metar_type,
    'METAR ' || CAST(event_id AS VARCHAR) AS raw_metar, CAST(25 + k % 25 AS DOUBLE) AS latitude,
    CAST(k % 50 - 120 AS DOUBLE) AS longitude, CAST(k * 10 AS DOUBLE) AS elevation_m,
    'awc_metar' AS source_name, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ingested_at FROM ev"""),
    "stations": (["rep"], """SELECT *, CASE WHEN icao_id IN ('KATL', 'KDFW', 'KDEN', 'KORD',
      'KLAX', 'KJFK', 'KSFO', 'KSEA', 'KLAS', 'KMCO') THEN substr(icao_id, 2) ELSE icao_id END
      AS iata_code FROM rep""")}
STATION_COLUMNS = ["icao_id", "iata_code", "obs_time", "receipt_time", "temp_c", "dewpoint_c",
                   "wind_dir_deg", "wind_speed_knots", "wind_gust_knots", "visibility_sm",
                   "altimeter_hpa", "sea_level_pres_hpa", "flight_category", "cloud_cover",
                   "metar_type", "raw_metar", "latitude", "longitude", "elevation_m", "source_name",
                   "ingested_at"]


@query("station_reports_from_json", with_tables(extra=STATIONS, body=f"""
SELECT {', '.join(STATION_COLUMNS)} FROM stations"""))
def station_reports_from_json(spark, sf):
    path = _landed(station_reports(spark, sf), "reports-json", "json")
    docs = weather.read_json(spark, path, S.OBSERVATION_SCHEMA, False)
    return weather.flatten_observations(docs).select(*STATION_COLUMNS)


def forecast_docs(spark, sf):
    """Events as forecasts: none, an empty list, or k % 4 periods."""
    k = F.col("k")
    start = F.unix_timestamp(F.col("ts").cast("timestamp"))
    period = lambda i: F.struct(
        F.when(k % 9 == 0, F.lit("soon")).otherwise((start + i * 3600).cast("string"))
        .alias("timeFrom"), (start + i * 3600 + 3600).cast("string").alias("timeTo"),
        F.when(i > 1, F.lit("TEMPO")).alias("fcstChange"),
        F.when(k % 7 == 0, F.lit("VRB")).otherwise((k * 3).cast("string")).alias("wdir"),
        (k % 40).cast("double").alias("wspd"),
        F.when(k % 3 == 0, (k % 40 + 10).cast("double")).alias("wgst"),
        F.when(k % 2 == 0, F.lit("6+")).otherwise(F.lit("6")).alias("visib"),
        F.when(k % 5 == 0, F.lit("-RA")).alias("wxString"),
        _one_of(CATEGORIES, k).alias("fltCat"))
    periods = F.transform(F.sequence(F.lit(1).cast("long"), (k % 4).cast("long")), period)
    listed = F.when(k % 4 > 0, periods).otherwise(F.array().cast(T.ArrayType(S.FORECAST_PERIOD)))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return base.events(spark, sf).select(
        F.col("event_id").cast("string").alias("rawTAF"), F.lit("KATL").alias("icaoId"),
        stamp.alias("issueTime"), F.when(k % 10 != 0, stamp).alias("bulletinTime"),
        (25 + k % 25).cast("double").alias("lat"), (k % 50 - 120).cast("double").alias("lon"),
        F.when(k % 11 != 0, listed).alias("fcsts"), stamp.alias("ingested_at"))


FORECASTS = {"bulletins": (["ev"], """
    SELECT *, 'KATL' AS icao_id, 'ATL' AS iata_code, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS issue_time,
      CASE WHEN k % 10 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS bulletin_time,
      CAST(event_id AS VARCHAR) AS raw_taf, CAST(25 + k % 25 AS DOUBLE) AS latitude,
      CAST(k % 50 - 120 AS DOUBLE) AS longitude, 'awc_taf' AS source_name,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ingested_at FROM ev"""),
    "periods": (["bulletins"], """
    SELECT icao_id, iata_code, issue_time, bulletin_time,
      CASE WHEN k % 9 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) + i * 3600 END AS valid_from,
      CAST(floor(epoch(ts)) AS BIGINT) + i * 3600 + 3600 AS valid_to,
      CASE WHEN i > 1 THEN 'TEMPO' END AS forecast_change_type,
      CASE WHEN k % 7 = 0 THEN 'VRB' ELSE CAST(k * 3 AS VARCHAR) END AS wind_dir_deg,
      CAST(k % 40 AS DOUBLE) AS wind_speed_knots,
      CASE WHEN k % 3 = 0 THEN CAST(k % 40 + 10 AS DOUBLE) END AS wind_gust_knots,
      CASE WHEN k % 2 = 0 THEN '6+' ELSE '6' END AS visibility_sm,
      CASE WHEN k % 5 = 0 THEN '-RA' END AS wx_string,
      (['VFR', 'MVFR', 'IFR', 'LIFR'])[k % 4 + 1] AS flight_category,
      raw_taf, latitude, longitude, source_name, ingested_at
    FROM bulletins, unnest(range(1, k % 4 + 1)) u(i) WHERE k % 11 <> 0
    UNION ALL SELECT icao_id, iata_code, issue_time, bulletin_time, NULL, NULL, NULL, NULL, NULL, NULL,
      NULL, NULL, NULL, raw_taf, latitude, longitude, source_name, ingested_at FROM bulletins
    WHERE k % 11 = 0""")}
FORECAST_COLUMNS = ["icao_id", "iata_code", "issue_time", "bulletin_time", "valid_from", "valid_to",
                    "forecast_change_type", "wind_dir_deg", "wind_speed_knots", "wind_gust_knots",
                    "visibility_sm", "wx_string", "flight_category", "raw_taf", "latitude",
                    "longitude", "source_name", "ingested_at"]


@query("forecast_periods_from_json", with_tables(extra=FORECASTS, body="SELECT * FROM periods"))
def forecast_periods_from_json(spark, sf):
    path = _landed(forecast_docs(spark, sf), "forecasts-json", "json")
    docs = weather.read_json(spark, path, S.FORECAST_SCHEMA, False)
    return weather.flatten_forecasts(docs).select(*FORECAST_COLUMNS)


@query("pruned_columns", "SELECT event_id, event_type FROM events")
def pruned_columns(spark, sf):
    return tables.read_columns(spark, f"{sf}/events.parquet", ["event_id", "event_type", "none"])


# --- sinks -----------------------------------------------------------------------------

@query("table_written_and_appended", with_tables("ontime", body="""
SELECT reporting_airline, count(*) * 2 AS n FROM ontime GROUP BY 1"""))
def table_written_and_appended(spark, sf):
    f, path = base.ontime(spark, sf), scratch(spark, "table")
    for mode in ("append", "TRUNCATE", "Append"):
        tables.write_table(f, path, mode)
    return spark.read.parquet(path).groupBy("reporting_airline").agg(
        F.count(F.lit(1)).alias("n"))


@query("table_description", """
SELECT CAST(column_index - 1 AS INTEGER) AS position, column_name, CASE data_type
    WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS column_type,
  (SELECT count(*) FROM orders) AS row_count
FROM duckdb_columns() WHERE table_name = 'orders'""")
def table_description(spark, sf):
    return tables.describe_table(base.table(spark, sf, "orders"))


def _dated_legs(spark, sf):
    day = F.col("flightdate").cast("date")
    return base.legs(spark, sf).withColumns({"year": F.year(day), "month": F.month(day)})


@query("month_loaded_twice", with_tables("ontime", body="""
SELECT year, month, count(*) AS n, 'loaded' AS first_try, 'already loaded' AS second_try,
  'not published' AS other_month FROM ontime GROUP BY 1, 2"""))
def month_loaded_twice(spark, sf):
    f, path = base.ontime(spark, sf), scratch(spark, "months")
    tries = [tables.load_month(f, path, 2024, m) for m in (1, 1, 2)]
    return spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n")).withColumns(dict(zip(
            ("first_try", "second_try", "other_month"), map(F.lit, tries))))


@query("backfilled_months", with_tables("legs", body="""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, count(*) AS n
FROM (SELECT CAST(flightdate AS DATE) AS d FROM legs)
WHERE d >= DATE '1994-11-01' AND d < DATE '2030-01-01' GROUP BY 1, 2"""))
def backfilled_months(spark, sf):
    path = scratch(spark, "backfill")
    tables.backfill(_dated_legs(spark, sf), path, "1994-11-01", "2029-12-01")
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query("months_without_flights", with_tables("legs", body="""
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
FROM range(TIMESTAMP '1994-11-01', TIMESTAMP '2002-07-01', INTERVAL 1 MONTH) t(m)
WHERE (year(m), month(m)) NOT IN (SELECT (year(CAST(flightdate AS DATE)),
  month(CAST(flightdate AS DATE))) FROM legs)"""))
def months_without_flights(spark, sf):
    wanted = tables.months_between(spark, "1994-11-01", "2002-06-01")
    return tables.missing_months(_dated_legs(spark, sf), wanted)


@query("weather_day_loaded", with_tables("archive_all", body="""
SELECT airport_code, strftime(t, '%Y-%m-%d %H:%M:%S') AS time, temperature_2m FROM archive_all
WHERE CAST(t AS DATE) = DATE '2024-01-11'"""))
def weather_day_loaded(spark, sf):
    archive, _, _ = base.weather_feeds(spark, sf, feeds=1)
    day = F.substring("time", 1, 10)
    full = archive.withColumns({"extract_start_date": day, "extract_end_date": day})
    path = scratch(spark, "days")
    for _ in range(2):
        tables.load_day(full, path, "2024-01-12")
    return spark.read.parquet(path).select(
        "airport_code", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
        "temperature_2m")


@query("combined_csv", with_tables("ontime", body="""
SELECT reporting_airline, count(*) AS n, count(origin) AS with_origin, count(tail_number) AS with_tail
FROM (SELECT reporting_airline, origin, NULL AS tail_number FROM ontime
  UNION ALL SELECT reporting_airline, NULL, tail_number FROM ontime) GROUP BY 1"""))
def combined_csv(spark, sf):
    f, path = base.ontime(spark, sf), scratch(spark, "combined")
    tables.write_combined([f.select("reporting_airline", "origin"),
                           f.select("reporting_airline", "tail_number")], path)
    return spark.read.csv(path, header=True).groupBy("reporting_airline").agg(
        F.count(F.lit(1)).alias("n"), F.count("origin").alias("with_origin"),
        F.count("tail_number").alias("with_tail"))


@query("exported_scores", with_tables("scores", body="""
SELECT flight_date, airline_code, "Origin", "Dest", scheduled_dep_hour, "Distance",
  dep_delay_minutes, arr_delay_minutes, CAST(is_delayed AS INTEGER) AS is_delayed, risk_score,
  risk_label, wind_speed_knots, temperature_c, precipitation_mm, cloud_cover_total_pct,
  flight_month, day_of_week, weather_delay_mins FROM scores"""))
def exported_scores(spark, sf):
    path = scratch(spark, "scores")
    tables.export_scores(base.scores(spark, sf), path)
    return tables.read_scores(spark, path)


@query("exported_centrality", with_tables(recursive=True, extra=HUBS, body="""
SELECT airport, round(pagerank, 9) AS pagerank, round(betweenness, 9) AS betweenness FROM hubs"""))
def exported_centrality(spark, sf):
    path = scratch(spark, "centrality")
    tables.export_centrality(base.centrality(spark, sf), path)
    return rounded(tables.read_centrality(spark, path), "pagerank", "betweenness")


@query("exported_sample", with_tables("ontime", body="""
SELECT flightdate, reporting_airline, CAST(flight_number_reporting_airline AS BIGINT) AS n, origin,
  tail_number FROM ontime ORDER BY flightdate, crsdeptime, flight_number_reporting_airline
LIMIT 1000"""))
def exported_sample(spark, sf):
    f, path = base.ontime(spark, sf), scratch(spark, "sample")
    tables.export_sample(f, path, ["flightdate", "crsdeptime",
                                   "flight_number_reporting_airline"])
    back = spark.read.csv(path, header=True)
    return back.select("flightdate", "reporting_airline", F.col("flight_number_reporting_airline")
                       .cast("bigint").alias("n"), "origin", "tail_number")


# --- clustered tables ---------------------------------------------------------

def _clustered(spark, sf):
    """Flights on a curve of origin and date, with Bloom filters on tail numbers."""
    return layout.write_clustered(base.ontime(spark, sf), scratch(spark, "curve"),
                                  ["origin", "flightdate"], bloom={"tail_number": 20_000})


CLUSTERED = """flightdate, origin, dest, tail_number, flight_number_reporting_airline, depdelay"""


@query("clustered_flights_in_range", with_tables("ontime", body=f"""
SELECT {CLUSTERED} FROM ontime WHERE origin IN ('A03', 'A04', 'A05')
  AND flightdate BETWEEN '2024-01-08' AND '2024-01-21'"""))
def clustered_flights_in_range(spark, sf):
    return _clustered(spark, sf).where(
        "origin IN ('A03', 'A04', 'A05') AND flightdate BETWEEN '2024-01-08' AND '2024-01-21'"
    ).select(*CLUSTERED.split(", "))


@query("clustered_flights_of_a_tail", with_tables("ontime", body=f"""
SELECT {CLUSTERED} FROM ontime WHERE tail_number = '7'"""))
def clustered_flights_of_a_tail(spark, sf):
    return _clustered(spark, sf).where("tail_number = '7'").select(*CLUSTERED.split(", "))


@query("clustered_origin_days", with_tables("ontime", body="""
SELECT origin, flightdate, count(*) AS flights, count(*) FILTER (WHERE depdelay > 15) AS late
FROM ontime GROUP BY origin, flightdate"""))
def clustered_origin_days(spark, sf):
    """A table appended to on the curve it was written with: the first half of each month, then the rest."""
    path, flights = scratch(spark, "curve"), base.ontime(spark, sf)
    layout.write_clustered(flights.where("dayofmonth <= 15"), path, ["flightdate", "origin"])
    return layout.append_clustered(flights.where("dayofmonth > 15"), path).groupBy(
        "origin", "flightdate").agg(F.count(F.lit(1)).alias("flights"),
                                    F.count_if(F.col("depdelay") > 15).alias("late"))
