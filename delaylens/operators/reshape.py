"""Column selection, wide/long reshaping, scaffolds, top-k and scaling."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from delaylens.functions import columns as C


def select_existing(df: DataFrame, wanted) -> DataFrame:
    """Keep the wanted columns that exist; all columns when none does."""
    kept = [c for c in wanted if c in df.columns]
    return df.select(*kept) if kept else df


def drop_prefix(df: DataFrame, *prefixes) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefixes)])


def rename(df: DataFrame, names: dict) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def union_all(*frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def melt(df: DataFrame, ids, values, name="variable", value="value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def pivot_mean(df: DataFrame, row, column, value, members) -> DataFrame:
    """Mean of ``value`` per row and per known member of ``column``."""
    return df.groupBy(row).pivot(column, list(members)).agg(F.avg(value))


def with_scaffold(df: DataFrame, key, members) -> DataFrame:
    """One row for each member in the given order, also for members without data."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    frame = spark.createDataFrame(list(enumerate(members)), f"position int, {key} {kind}")
    return frame.join(df, key, "left")


def top_k(df: DataFrame, by, k, tie, descending=True, display_ascending=False) -> DataFrame:
    """First k rows by a measure with a key as tie-break, optionally re-sorted for display."""
    ties = [tie] if isinstance(tie, str) else list(tie)
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    best = df.orderBy(first, *ties).limit(k)
    return best.orderBy(F.col(by).asc(), *ties) if display_ascending else best


def min_max(df: DataFrame, column, out="scaled", clip_q=None) -> DataFrame:
    """(x - min) / (max - min) after an optional upper clip at a quantile.

    For tables of bounded size (airports, routes): the one-row statistics come
    from scalar subqueries.
    """
    x = F.col(column)
    if clip_q is not None:
        x = F.least(x, df.agg(F.percentile(column, F.lit(clip_q))).scalar())
    clipped = df.withColumn(out, x)
    ends = clipped.agg(F.struct(F.min(out).alias("low"), (F.max(out) - F.min(out)).alias("span")))
    e = F.col("_ends")
    return clipped.withColumn("_ends", ends.scalar()).withColumn(out, F.coalesce(
        F.try_divide(F.col(out) - e["low"], e["span"]), F.lit(0.0))).drop("_ends")


def impute(df: DataFrame, fills: dict) -> DataFrame:
    return df.fillna({c: v for c, v in fills.items() if c in df.columns})


def sample_n(df: DataFrame, key, n, prefix_buckets=4096) -> DataFrame:
    """At most n rows in the order of the md5 of the key, the same ones every time.

    A count per hash prefix finds how many prefixes hold n rows, so only about
    n rows reach the final sort however large the input is.
    """
    hashed = df.withColumn("_h", F.md5(F.col(key).cast("string")))
    width = len(f"{prefix_buckets - 1:x}")
    hashed = hashed.withColumn("_p", F.conv(F.substring("_h", 1, width), 16, 10).cast("int"))
    sizes = hashed.groupBy("_p").count()
    # at most ``prefix_buckets`` rows, so an array of them fits one row
    curve = sizes.agg(F.sort_array(F.collect_list(F.struct("_p", "count"))).alias("s"))
    reach = F.aggregate(
        "s", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("p")),
        lambda acc, e: F.when(acc["n"] >= n, acc).otherwise(
            F.struct((acc["n"] + e["count"]).alias("n"), e["_p"].alias("p"))))
    cutoff = curve.select(reach["p"].alias("p"))
    near = hashed.where(F.col("_p") <= cutoff.scalar())
    return near.orderBy("_h", key).limit(n).drop("_h", "_p")
