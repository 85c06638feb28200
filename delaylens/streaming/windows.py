"""Event-time aggregates of station reports: airport-hours in update mode, and sessions of reports.

State is kept per open window and dropped once the watermark has passed it, so it grows with the
allowed delay and not with the stream. Reports later than ``delay`` behind the newest one may be left
out of windows that are closed by then; choose it above the longest delay to be counted.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from delaylens.session import cut
from delaylens.sources.tables import replace_partitions, table_exists

HOUR_KEY = ["iata_code", "hour_start"]


def timed(reports: DataFrame, delay) -> DataFrame:
    """Reports with a readable time, as event time ``at`` under a watermark."""
    return (reports.withColumn("at", F.col("obs_time").try_cast("timestamp"))
            .where("at IS NOT NULL").withWatermark("at", delay))


def hourly(reports: DataFrame, delay="2 hours") -> DataFrame:
    """Reports, mean temperature and strongest wind per airport and hour of event time."""
    return (timed(reports, delay).groupBy("iata_code", F.window("at", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("reports"), F.avg("temp_c").alias("mean_temp_c"),
                 F.max("wind_speed_knots").alias("max_wind_knots"))
            .select("iata_code", F.col("w.start").alias("hour_start"), "reports", "mean_temp_c",
                    "max_wind_knots"))


def keep_updated(updates: DataFrame, table, checkpoint) -> StreamingQuery:
    """Hours that changed replace their older values; the table has one partition per day.

    A row of a batch is the whole value of its hour, so a repeated batch changes nothing.
    """
    def merge(batch: DataFrame, _):
        spark = batch.sparkSession
        rows = cut(batch.withColumn("day", F.to_date("hour_start")))
        if table_exists(spark, table):
            days = rows.select("day").distinct()
            kept = (spark.read.schema(rows.schema).parquet(table).join(days, "day", "left_semi")
                    .join(rows.select(*HOUR_KEY), HOUR_KEY, "left_anti"))
            rows = cut(rows.unionByName(kept))
        replace_partitions(rows, table, "day")

    return (updates.writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def sessions(reports: DataFrame, gap="3 hours", delay="2 hours") -> DataFrame:
    """Stretches in which an airport reports without a pause beyond ``gap``: first, last and number.

    A session is given out once the watermark has passed its end.
    """
    return (timed(reports, delay).groupBy("iata_code", F.session_window("at", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("reports"), F.max("at").alias("last_report"))
            .select("iata_code", F.col("w.start").alias("first_report"), "last_report", "reports"))


def keep_closed(closed: DataFrame, target, checkpoint) -> StreamingQuery:
    return (closed.writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target))
