"""Ordered computations split into chunks, so no task holds a whole group.

Both helpers take a *chunk*: a column that never decreases along the order.
A task sees one (group, chunk); what must cross a chunk border is carried by a
table with one small row per (group, chunk).
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from delaylens.functions import columns as C



def _no_date(c: Column) -> Column:
    return F.coalesce(c, F.to_date(F.lit("0001-01-01")))


def chunk_keys(df: DataFrame, group, day) -> DataFrame:
    """Add the non-NULL keys ``_g`` (group) and ``_d`` (day; NULL sorts first)."""
    return df.withColumns({"_g": C.group_token(group), "_d": _no_date(F.col(day))})


def day_tails(df: DataFrame, order, payload, depth) -> DataFrame:
    """(_g, _d, _tail): the last ``depth`` rows of each group and day, latest first."""
    in_day = W.partitionBy("_g", "_d").orderBy(*order)
    marked = df.select(
        "_g", "_d", F.struct(*payload).alias("_row"),
        F.row_number().over(in_day).alias("_rn"),
        F.lead(F.lit(1), depth).over(in_day).isNull().alias("_last"),
    )
    tails = (
        marked.where("_last").groupBy("_g", "_d")
        .agg(F.sort_array(F.collect_list(F.struct("_rn", "_row")), asc=False).alias("_tail"))
    )
    return tails.withColumn("_tail", F.transform("_tail", lambda x: x["_row"]))


def rows_before(depth, tail="_tail", group="_g", day="_d"):
    """The last ``depth`` rows of earlier days, latest first, from one tail per group and day.

    Every day has at least one row, so the tails of ``depth`` days before are enough.
    """
    earlier = W.partitionBy(group).orderBy(F.col(day).desc()).rowsBetween(1, depth)
    return F.slice(F.flatten(F.collect_list(tail).over(earlier)), 1, depth)


def carried_rows(df: DataFrame, order, payload, depth) -> DataFrame:
    """For each (_g, _d): its last ``depth`` earlier rows, latest first, as ``_carry``."""
    return day_tails(df, order, payload, depth).select("_g", "_d", rows_before(depth).alias("_carry"))


def with_previous(df: DataFrame, order, payload, features, narrow=None, carry=None) -> DataFrame:
    """Add features over the rows before each row of its group.

    ``df`` has ``_g`` and ``_d``. ``features`` maps a column name to
    (n, over, merge): ``over(window)`` is the native window column over the n
    rows before within the day, and ``merge(here, rows)`` completes it near the
    start of a day from the carried rows that are still within reach (latest
    first). ``narrow`` is a cheaper frame with the same rows, if there is one,
    from which the carried rows are taken; ``carry`` has them ready, if they are
    stored (``df`` may then be any whole days).
    """
    in_day = W.partitionBy("_g", "_d").orderBy(*order)
    depth = max(n for n, _, _ in features.values())
    if carry is None:
        carry = carried_rows(df if narrow is None else narrow, order, payload, depth)
    seen = df.select(
        "*", F.row_number().over(in_day).alias("_rn"),
        *[over(in_day).alias(f"_in_{name}") for name, (_, over, _) in features.items()],
    )
    nothing = F.array().cast(carry.schema["_carry"].dataType)

    def complete(name, n, merge):
        here, reach = F.col(f"_in_{name}"), n + 1 - F.col("_rn")
        rows = F.slice(F.coalesce("_carry", nothing), F.lit(1), reach)
        return F.when(F.col("_rn") > n, here).otherwise(merge(here, rows)).alias(name)

    return seen.join(carry, ["_g", "_d"], "left").select(
        *df.columns, *[complete(name, n, merge) for name, (n, _, merge) in features.items()])


def running_totals(df: DataFrame, group, chunk: Column, order, sums) -> DataFrame:
    """Inclusive running sums along ``order`` within each group.

    The input should already be aggregated to one row per ordered value.
    ``chunk`` takes a bounded number of values and rises along the order.
    """
    group = list(group)
    chunked = df.withColumn("_c", chunk)
    inside = (W.partitionBy(*group, "_c").orderBy(*order)
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    before = W.partitionBy(*group).orderBy("_c").rowsBetween(W.unboundedPreceding, -1)
    per_chunk = chunked.groupBy(*group, "_c").agg(*[F.sum(s).alias(s) for s in sums])
    offsets = per_chunk.select(
        *group, "_c", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_o_{s}") for s in sums])
    local = chunked.select("*", *[F.sum(s).over(inside).alias(f"_l_{s}") for s in sums])
    return local.join(offsets, [*group, "_c"]).select(
        *df.columns, *[(F.col(f"_l_{s}") + F.col(f"_o_{s}")).alias(f"running_{s}") for s in sums])
