"""Type-2 history of a table, by comparing check columns."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from delaylens import schemas as S
from delaylens.operators.dedup import first_per_key
from delaylens.session import cut

VERSION_COLUMNS = ["valid_from", "valid_to", "is_current"]


def open_history(current: DataFrame, as_of) -> DataFrame:
    """First version of every row."""
    start = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return current.select(
        "*", start.cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"))


def snapshot_scd2(current: DataFrame, history: DataFrame, key="flight_id",
                  check_cols=S.SNAPSHOT_CHECK_COLUMNS, as_of=None) -> DataFrame:
    """History after comparing ``current`` with the open versions.

    New keys are opened, changed keys are closed and opened again, keys that
    are unchanged or not seen keep their open version. Only the key and the
    check columns are compared; whole rows meet nothing but the keys that
    changed or are new. Of several current rows with one key, the first in the
    order of check columns and then all columns counts. Rows with a NULL key
    match nothing and are added every time.
    """
    now = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    body = [c for c in history.columns if c not in VERSION_COLUMNS]
    checks = F.struct(*check_cols)
    keyed = current.where(F.col(key).isNotNull()).select(*body)
    opened = history.where(F.col("is_current") & F.col(key).isNotNull())

    seen = keyed.groupBy(F.col(key).alias("_key")).agg(F.min(checks).alias("_now"))
    known = opened.select(F.col(key).alias("_known"), checks.alias("_was"))
    moved = cut(seen.join(known, F.col("_key") == F.col("_known"), "left").where(
        F.col("_known").isNull() | ~F.col("_now").eqNullSafe(F.col("_was"))).select("_key"))

    begun = first_per_key(keyed.join(moved, F.col(key) == F.col("_key"), "left_semi"), [key],
                          [*check_cols, *[c for c in body if c not in check_cols]])
    closing = F.col("_key").isNotNull()
    kept = opened.join(moved, F.col(key) == F.col("_key"), "left").select(
        *body, "valid_from", F.when(closing, now).cast("timestamp").alias("valid_to"),
        (~closing).alias("is_current"))
    settled = history.where(~F.col("is_current") | F.col(key).isNull())
    unkeyed = open_history(current.where(F.col(key).isNull()).select(*body), now)
    return reduce(DataFrame.unionByName, [
        settled.select(*body, *VERSION_COLUMNS), unkeyed, kept, open_history(begun, now)])
