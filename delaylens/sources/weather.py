"""Weather documents: archive arrays, station observations, nested forecasts."""

from pyspark.sql import Column, DataFrame, functions as F

from delaylens import schemas as S


def read_json(spark, path, schema, multiline=True) -> DataFrame:
    """Documents, or lists of documents, with a declared schema."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def explode_hourly(docs: DataFrame, source=S.ARCHIVE_SOURCE) -> DataFrame:
    """One row per hour from documents of parallel arrays; documents without hours give none.

    A measure that a document lacks is NULL in its rows.
    """
    fields = docs.schema["hourly"].dataType
    arrays = [F.coalesce(F.col(f"hourly.{f.name}"), F.array().cast(f.dataType)).alias(f.name)
              for f in fields]
    zipped, fields = F.arrays_zip(*arrays), fields.names
    return docs.where(F.col("hourly").isNotNull()).select(
        F.inline(zipped).alias(*fields), "airport_code", "extract_start_date",
        "extract_end_date").withColumn("source_name", F.lit(source))


def without_hours(docs: DataFrame) -> DataFrame:
    """Airports whose document has no hourly block."""
    return docs.where(F.col("hourly").isNull()).select("airport_code")


def airport_of(station) -> Column:
    """Airport code of a weather station, the station code when it is not known."""
    known = F.create_map(*[F.lit(x) for pair in S.STATION_TO_AIRPORT.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.col(station)), F.col(station))


def flatten_observations(docs: DataFrame) -> DataFrame:
    """Station reports on 21 named columns."""
    return docs.select(
        F.col("icaoId").alias("icao_id"), airport_of("icaoId").alias("iata_code"),
        F.col("reportTime").alias("obs_time"), F.col("receiptTime").alias("receipt_time"),
        F.col("temp").alias("temp_c"), F.col("dewp").alias("dewpoint_c"),
        F.col("wdir").alias("wind_dir_deg"), F.col("wspd").alias("wind_speed_knots"),
        F.col("wgst").alias("wind_gust_knots"), F.col("visib").alias("visibility_sm"),
        F.col("altim").alias("altimeter_hpa"), F.col("slp").alias("sea_level_pres_hpa"),
        F.col("fltCat").alias("flight_category"), F.col("cover").alias("cloud_cover"),
        F.col("metarType").alias("metar_type"), F.col("rawOb").alias("raw_metar"),
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("elev").alias("elevation_m"), F.lit(S.OBSERVATION_SOURCE).alias("source_name"),
        F.col("ingested_at"))


def flatten_forecasts(docs: DataFrame) -> DataFrame:
    """One row per forecast period on 18 columns.

    A document without periods gives one empty period, an empty list none.
    """
    blank = F.array(F.lit(None).cast(S.FORECAST_PERIOD))
    periods = docs.withColumn("p", F.explode(F.coalesce("fcsts", blank)))
    epoch = lambda c: F.col(c).try_cast("double").try_cast("long")
    return periods.select(
        F.col("icaoId").alias("icao_id"), airport_of("icaoId").alias("iata_code"),
        F.col("issueTime").alias("issue_time"), F.col("bulletinTime").alias("bulletin_time"),
        epoch("p.timeFrom").alias("valid_from"), epoch("p.timeTo").alias("valid_to"),
        F.col("p.fcstChange").alias("forecast_change_type"),
        F.col("p.wdir").alias("wind_dir_deg"), F.col("p.wspd").alias("wind_speed_knots"),
        F.col("p.wgst").alias("wind_gust_knots"), F.col("p.visib").alias("visibility_sm"),
        F.col("p.wxString").alias("wx_string"), F.col("p.fltCat").alias("flight_category"),
        F.col("rawTAF").alias("raw_taf"), F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"), F.lit(S.FORECAST_SOURCE).alias("source_name"),
        F.col("ingested_at"))
