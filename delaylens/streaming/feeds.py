"""Observation and forecast feeds: landing folder -> table, state and airport-hours."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from delaylens import schemas as S
from delaylens.operators.dedup import latest_by
from delaylens.plans.staging import best_source
from delaylens.session import cut
from delaylens.sources import weather
from delaylens.sources.tables import replace_partitions, table_exists


def _landing(spark, schema, folder, files_per_batch):
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def observations(spark: SparkSession, folder, files_per_batch=None) -> DataFrame:
    """Stream of station reports from JSON files; empty files add nothing.

    ``files_per_batch`` bounds a batch, so that a backlog is worked off in steps.
    """
    return weather.flatten_observations(
        _landing(spark, S.OBSERVATION_SCHEMA, folder, files_per_batch))


def forecasts(spark: SparkSession, folder, files_per_batch=None) -> DataFrame:
    return weather.flatten_forecasts(_landing(spark, S.FORECAST_SCHEMA, folder, files_per_batch))


def _append(stream, target, checkpoint) -> StreamingQuery:
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target))


def ingest_observations(spark, folder, target, checkpoint, files_per_batch=None) -> StreamingQuery:
    return _append(observations(spark, folder, files_per_batch), target, checkpoint)


def ingest_forecasts(spark, folder, target, checkpoint, files_per_batch=None) -> StreamingQuery:
    return _append(forecasts(spark, folder, files_per_batch), target, checkpoint)


# --- one row per report ---------------------------------------------------------

DISTINCT_KEY = ("icao_id", "obs_time")


def add_distinct(rows: DataFrame, table, key=DISTINCT_KEY, time="obs_time") -> None:
    """Append the reports that the table does not have yet, however late they are.

    The table has one partition per day of the report; only the days of the batch
    are compared. A repeated batch finds its rows there and adds nothing. Reports
    without a readable time go to the partition of the null day; NULL keys are equal.
    """
    spark = rows.sparkSession
    day = F.col(time).try_cast("timestamp").cast("date")
    fresh = cut(rows.withColumn("report_day", day).dropDuplicates(list(key)))
    if table_exists(spark, table):
        days = fresh.select("report_day").distinct()
        kept = spark.read.schema(fresh.select(*key, "report_day").schema).parquet(table)
        seen = (kept.join(days, "report_day", "left_semi")
                .unionByName(kept.where(F.col("report_day").isNull()))
                .select(*(F.col(c).alias(f"seen_{c}") for c in key)))
        same = [F.col(c).eqNullSafe(F.col(f"seen_{c}")) for c in key]
        fresh = fresh.join(seen, same, "left_anti")
    fresh.write.mode("append").partitionBy("report_day").parquet(table)


def ingest_distinct(spark, folder, target, checkpoint, files_per_batch=None) -> StreamingQuery:
    """Every distinct report once, in whatever batch it first arrives."""
    stream = observations(spark, folder, files_per_batch)
    return (stream.writeStream.foreachBatch(lambda batch, _: add_distinct(batch, target))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# --- latest state per airport --------------------------------------------------

def _newest():
    return [F.desc("ingested_at"), F.desc("obs_time"), F.desc("temp_c"),
            F.desc("wind_speed_knots")]


def latest_observations(rows: DataFrame) -> DataFrame:
    return latest_by(rows, "iata_code", _newest())


def read_state(spark: SparkSession, folder) -> DataFrame:
    """The state after the last finished batch."""
    rows = spark.read.parquet(folder)
    newest = rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar())
    return newest.drop("batch", "slot")


def latest_state(stream: DataFrame, folder, checkpoint) -> StreamingQuery:
    """Keep one row per airport. Each batch writes a new version of the small state in
    place of the last but one, so a repeated batch gives the same result and two
    versions are kept."""
    def merge(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        if table_exists(spark, folder):
            older = spark.read.parquet(folder).where(F.col("batch") < batch_id)
            seen = older.where(F.col("batch") == older.agg(F.max("batch")).scalar())
            batch = batch.unionByName(seen.drop("batch", "slot"))
        state = latest_observations(batch).withColumns(
            {"batch": F.lit(batch_id), "slot": F.lit(batch_id % 2)})
        replace_partitions(state, folder, "slot")

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# --- airport-hour weather --------------------------------------------------------

def upsert_airport_hours(rows: DataFrame, table) -> None:
    """Merge weather rows into a table of best airport-hours, one partition per day.

    The batch is reduced to its own best rows first; only its days are read and
    rewritten. Merged rows are checkpointed before they replace the partitions
    they were read from, so a repeated batch gives the same table.
    """
    spark = rows.sparkSession
    merged = cut(best_source(rows))
    if table_exists(spark, table):
        days = merged.select("date_id").distinct()
        present = spark.read.parquet(table).join(days, "date_id", "left_semi")
        merged = cut(best_source(merged.unionByName(present)))
    replace_partitions(merged, table, "date_id")


def stream_airport_hours(stream: DataFrame, table, checkpoint) -> StreamingQuery:
    """Late or better reports replace worse ones in the airport-hour table."""
    return (stream.writeStream.foreachBatch(lambda batch, _: upsert_airport_hours(batch, table))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
