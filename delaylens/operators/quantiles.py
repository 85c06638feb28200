"""Exact, interpolated quantiles of any number of columns in one distributed job."""

from pyspark.sql import DataFrame, Window as W, functions as F

from delaylens.session import cut

CHUNKS = 256


def value_counts(df: DataFrame, columns) -> DataFrame:
    """(feature, value, n), NULLs left out."""
    as_double = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return (as_double.unpivot([], list(columns), "feature", "value")
            .where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def quantiles(df: DataFrame, columns, probs, chunks=CHUNKS) -> DataFrame:
    """(feature, p, value) by linear interpolation between order statistics.

    Values are counted once. Totals of ``chunks`` value ranges (bounds from a
    mergeable sketch) tell which range holds each wanted rank; only those ranges
    are sorted, so neither a column nor a skewed value has to fit one task.
    """
    counts = cut(value_counts(df, columns))
    steps = F.array(*[F.lit(i / chunks) for i in range(1, chunks)])
    bounds = counts.groupBy("feature").agg(
        F.percentile_approx("value", steps, 10000).alias("_b"), F.sum("n").alias("total"))
    # one row per requested column on the broadcast side
    chunked = counts.join(F.broadcast(bounds.drop("total")), "feature").withColumn(
        "_at", F.size(F.filter("_b", lambda b: b < F.col("value")))).drop("_b")
    order = W.partitionBy("feature").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    ranges = (chunked.groupBy("feature", "_at").agg(F.sum("n").alias("size"))
              .withColumn("end", F.sum("size").over(order)))
    spot = F.col("p") * (F.col("total") - 1)
    wanted = bounds.select("feature", "total", F.explode(
        F.array(*[F.lit(float(p)) for p in probs])).alias("p")).select(
        "feature", "p", (spot - F.floor(spot)).alias("w"),
        F.explode(F.array(F.floor(spot), F.ceil(spot))).alias("rank")).distinct()
    # columns x probabilities x 2 rows
    found = wanted.join(ranges, "feature").where(
        (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("size"))).select(
        "feature", "p", "w", "rank", "_at", (F.col("end") - F.col("size")).alias("start"))
    found = F.broadcast(found)
    inside = W.partitionBy("feature", "_at").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    sorted_ = chunked.join(F.broadcast(found.select("feature", "_at", "start").distinct()),
                           ["feature", "_at"]).withColumn(
        "upto", F.col("start") + F.sum("n").over(inside)).drop("start")
    hits = sorted_.join(found, ["feature", "_at"]).where(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    low, high = F.min("value"), F.max("value")
    return hits.groupBy("feature", "p").agg((low + F.max("w") * (high - low)).alias("value"))


def medians(df: DataFrame, columns) -> DataFrame:
    """(feature, median)."""
    return quantiles(df, columns, [0.5]).select("feature", F.col("value").alias("median"))


def impute_medians(df: DataFrame, columns):
    """Fill NULLs with the column median.

    Returns the filled frame and the report (feature, missing, median). The
    report has one row per column; it is joined to every row as one map.
    """
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    missing = gaps.unpivot([], list(columns), "feature", "missing")
    report = cut(missing.join(medians(df, columns), "feature", "left"))
    middles = report.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    known = df.withColumn("_medians", middles)
    filled = known.withColumns({c: F.coalesce(
        F.col(c).cast("double"), F.try_element_at("_medians", F.lit(c))) for c in columns})
    return filled.drop("_medians"), report
