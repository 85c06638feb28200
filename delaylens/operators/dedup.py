"""Keep-one rules and duplicate listings."""

from pyspark.sql import DataFrame, Window as W, functions as F


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key in the given order.

    A rank limit of one is applied before the shuffle as well, so a key with
    very many rows sends one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def latest_by(df: DataFrame, key, newest_first) -> DataFrame:
    return first_per_key(df.where(F.col(key).isNotNull()), key, newest_first)


def duplicates(df: DataFrame, keys) -> DataFrame:
    """All members of keys that occur more than once (NULL keys never match).

    Counting comes first and is combined map-side; the rows are then found by
    a semi join, which can be split when a key is very frequent.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    repeated = df.groupBy(*keys).count().where(F.col("count") > 1).select(*keys)
    return df.join(repeated, keys, "left_semi")
