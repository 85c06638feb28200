"""Column profiles of a table, kept per month as sketches that merge.

A month is read once, when it is loaded or corrected: ``update`` writes one small row per column
(counts, range, sums, a quantile sketch, a distinct-value sketch) and a count-min table, all below one
folder and partitioned by month. Reports over any range of months then read those rows alone.

* Quantiles come from KLL sketches (Karnin, Lang & Liberty, 2016). A column with at most about ``k`` values
  is kept whole; beyond, the rank of an answer is off by about 2 / k.
* Distinct counts come from theta sketches of ``2 ** lg`` values: exact below, then with a relative standard
  error of 1 / sqrt(2 ** lg).
* Frequencies of given values come from ``DEPTH`` hashed counters per value: never too low, and too
  high by more than 2 n / ``width`` with a probability of 2 ** -DEPTH.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.sources.tables import replace_partitions

MONTH = ["year", "month"]
DEPTH = 4


def _column_row(name, kind, k, lg):
    """One struct per column; text columns have no sums and quantiles."""
    c = F.col(name)
    number = c.cast("double") if kind == "number" else F.lit(None).cast("double")
    sketch = (F.kll_sketch_agg_double(number, k) if kind == "number"
              else F.max(F.lit(None).cast("binary")))
    return F.struct(
        F.lit(name).alias("column_name"), F.lit(kind).alias("kind"),
        F.count(F.lit(1)).alias("row_count"), F.count(c).alias("present"),
        F.min(number).alias("low"), F.max(number).alias("high"), F.sum(number).alias("total"),
        F.sum(number * number).alias("squares"), sketch.alias("ranks"),
        F.theta_sketch_agg(c.cast("string"), lg).alias("members"))


def _cells(name, width, label):
    """The counters of a value: one in each row, for the column that ``label`` names."""
    value = F.col(name).cast("string")
    return [F.struct(label.alias("column_name"), F.lit(i).alias("hash_row"), F.pmod(
        F.xxhash64(F.lit(i), value), F.lit(width)).alias("cell"), value.isNotNull().alias("known"))
        for i in range(DEPTH)]


def update(df: DataFrame, path, numbers=(), texts=(), k=2048, lg=12, width=4096) -> None:
    """Profile the months present in ``df`` (columns year, month) and replace them in the folder."""
    wanted = [(n, "number") for n in numbers] + [(t, "text") for t in texts]
    rows = df.groupBy(*MONTH).agg(
        F.array(*[_column_row(n, kind, k, lg) for n, kind in wanted]).alias("c"))
    replace_partitions(rows.select(*MONTH, F.inline("c")), f"{path}/columns", *MONTH)
    if texts:
        cells = F.array(*[c for t in texts for c in _cells(t, width, F.lit(t))])
        counted = (df.select(*MONTH, F.explode(cells).alias("x")).select(*MONTH, "x.*").where("known")
                   .groupBy(*MONTH, "column_name", "hash_row", "cell").agg(F.count(F.lit(1)).alias("n")))
        replace_partitions(counted.withColumn("width", F.lit(width)), f"{path}/counters", *MONTH)


def _between(df, first, last):
    """Months from (year, month) to (year, month), both included; partitions are pruned."""
    at = F.col("year") * 12 + F.col("month")
    if first:
        df = df.where((F.col("year") >= first[0]) & (at >= first[0] * 12 + first[1]))
    if last:
        df = df.where((F.col("year") <= last[0]) & (at <= last[0] * 12 + last[1]))
    return df


def summary(spark: SparkSession, path, first=None, last=None, by=()) -> DataFrame:
    """Rows, missing and distinct values, range, mean and deviation per column (and per ``by``)."""
    rows = _between(spark.read.parquet(f"{path}/columns"), first, last)
    present, total = F.sum("present"), F.sum("total")
    mean = F.try_divide(total, present)
    spread = F.try_divide(F.sum("squares") - total * mean, present - 1)
    return rows.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), (F.sum("row_count") - present).alias("missing"),
        F.theta_sketch_estimate(F.theta_union_agg("members")).alias("distinct_values"),
        F.min("low").alias("low"), F.max("high").alias("high"), mean.alias("mean"),
        F.sqrt(F.when(spread > 0, spread).otherwise(spread * 0)).alias("std"))


def quantiles(spark: SparkSession, path, shares, first=None, last=None, by=()) -> DataFrame:
    """(column_name, p, value) of the number columns: the smallest value of at least rank p."""
    rows = _between(spark.read.parquet(f"{path}/columns"), first, last).where(
        "kind = 'number' AND present > 0")
    merged = rows.groupBy(*by, "column_name").agg(F.kll_merge_agg_double("ranks").alias("ranks"))
    return merged.select(*by, "column_name", F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("p"),
                 F.kll_sketch_get_quantile_double("ranks", F.lit(float(p))).alias("value"))
        for p in shares])).alias("q")).select(*by, "column_name", "q.*")


def frequencies(spark: SparkSession, path, values: DataFrame, first=None, last=None) -> DataFrame:
    """``values(column_name, value)`` with how often each occurs, at most a little too high."""
    cells = _between(spark.read.parquet(f"{path}/counters"), first, last)
    width = cells.agg(F.max("width")).first()[0]
    if width is None:
        return values.withColumn("n", F.lit(0).cast("long"))
    asked = values.select("value", F.explode(F.array(*_cells(
        "value", width, F.col("column_name")))).alias("x")).select("value", "x.*")
    found = asked.join(cells.groupBy("column_name", "hash_row", "cell").agg(F.sum("n").alias("n")),
                       ["column_name", "hash_row", "cell"], "left")
    return found.groupBy("column_name", "value").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"))
