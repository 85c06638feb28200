"""Table reads and writes: modes, idempotent loads, exports."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens import schemas as S
from delaylens.operators.reshape import select_existing, union_all

WRITE_MODES = {"TRUNCATE": "overwrite", "APPEND": "append"}


def read_columns(spark: SparkSession, path, columns) -> DataFrame:
    """Parquet scan limited to the named columns that exist."""
    return select_existing(spark.read.parquet(path), columns)


def table_exists(spark: SparkSession, path) -> bool:
    """Whether the path exists; only its listing is looked at."""
    try:
        spark.read.text(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _gathered(df, partition_by):
    """Rows of one partition folder in few tasks, so few files; large folders are split again."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(df: DataFrame, path, mode="TRUNCATE", partition_by=()) -> None:
    """Write a Parquet table; the mode is TRUNCATE or APPEND in any case."""
    if mode.upper() not in WRITE_MODES:
        raise ValueError(f"mode must be TRUNCATE or APPEND, not {mode!r}")
    writer = _gathered(df, partition_by).write.mode(WRITE_MODES[mode.upper()]).option(
        "partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_csv(spark: SparkSession, csv_path, path, mode="TRUNCATE") -> DataFrame:
    """Load a CSV with inferred types into a table; returns its description."""
    if not table_exists(spark, csv_path):
        raise FileNotFoundError(csv_path)
    write_table(spark.read.csv(csv_path, header=True, inferSchema=True), path, mode)
    return describe_table(spark.read.parquet(path))


def replace_partitions(df: DataFrame, path, *partition_by) -> None:
    """Replace only the partitions present in ``df``, so a repeated load changes nothing."""
    (_gathered(df, partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def describe_table(df: DataFrame) -> DataFrame:
    """(column_name, column_type, row_count) of a loaded table."""
    fields = df.sparkSession.createDataFrame(
        [(i, n, t) for i, (n, t) in enumerate(df.dtypes)],
        "position int, column_name string, column_type string")
    return fields.withColumn("row_count", df.agg(F.count(F.lit(1))).scalar())


def months_between(spark: SparkSession, start, end) -> DataFrame:
    """(year, month) of every calendar month from start to end, both included."""
    first, last = (F.to_date(F.lit(d)) for d in (start, end))
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH"))
    return (spark.range(1).select(F.explode(months).alias("m"))
            .select(F.year("m").alias("year"), F.month("m").alias("month")))


def load_month(df: DataFrame, path, year, month) -> str:
    """Load one month unless the table has it or the input has no rows for it."""
    spark = df.sparkSession
    this_month = (F.col("year") == year) & (F.col("month") == month)
    if table_exists(spark, path) and not spark.read.parquet(path).where(this_month).isEmpty():
        return "already loaded"
    rows = df.where(this_month)
    if rows.isEmpty():
        return "not published"
    replace_partitions(rows, path, "year", "month")
    return "loaded"


def load_day(df: DataFrame, path, logical_date) -> None:
    """Load the day before the logical date; an empty day is an error."""
    day = F.date_sub(F.to_date(F.lit(logical_date)), 1)
    typed = df.withColumns({
        "time": F.col("time").cast("timestamp"),
        "extract_start_date": F.col("extract_start_date").cast("date"),
        "extract_end_date": F.col("extract_end_date").cast("date")})
    rows = typed.withColumn("day", F.to_date("time")).where(F.col("day") == day)
    if rows.isEmpty():
        raise ValueError(f"no weather for the day before {logical_date}")
    replace_partitions(rows, path, "day")


def missing_months(loaded: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted months without a row in the loaded table."""
    return wanted.join(loaded.select("year", "month").distinct(), ["year", "month"], "left_anti")


def backfill(rows: DataFrame, path, start, end) -> DataFrame:
    """Load all months of the range in one job; returns the months that had no rows."""
    typed = rows.withColumns({c: F.col(c).cast("int") for c in ("year", "month")})
    wanted = months_between(rows.sparkSession, start, end)
    write_table(typed.join(wanted, ["year", "month"], "left_semi"), path, "TRUNCATE",
                ["year", "month"])
    return missing_months(rows.sparkSession.read.parquet(path), wanted)


def write_combined(frames, path) -> DataFrame:
    """Union of frames with differing columns, written as CSV."""
    combined = union_all(*frames)
    combined.write.mode("overwrite").csv(path, header=True)
    return combined


def export_scores(scores: DataFrame, path) -> None:
    select_existing(scores, S.SCORE_COLUMNS).write.mode("overwrite").parquet(path)


def export_centrality(centrality: DataFrame, path) -> None:
    centrality.select("airport", "pagerank", "betweenness").write.mode("overwrite").csv(
        path, header=True)


def read_scores(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def read_centrality(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, header=True,
                          schema="airport string, pagerank double, betweenness double")


def sample_rows(df: DataFrame, order, columns=S.SAMPLE_COLUMNS, n=1000) -> DataFrame:
    """The first n rows in a stated order on the sample columns."""
    names = {c.lower(): c for c in df.columns}
    kept = [names[c.lower()] for c in columns if c.lower() in names]
    return df.orderBy(*order).limit(n).select(*kept)


def export_sample(df: DataFrame, path, order, columns=S.SAMPLE_COLUMNS, n=1000, times=()) -> None:
    """Small CSV sample; time columns are written to the second."""
    rows = sample_rows(df, order, columns, n)
    shown = {t: F.date_format(F.col(t).cast("timestamp"), "yyyy-MM-dd HH:mm:ss") for t in times}
    rows.withColumns(shown).write.mode("overwrite").csv(path, header=True)
