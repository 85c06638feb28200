"""Optional, conjunctive row filters for flights and scored flights."""

from dataclasses import dataclass
from functools import reduce
from typing import Optional, Sequence, Tuple

from pyspark.sql import Column, DataFrame, functions as F

from delaylens.functions import columns as C


def operated() -> Column:
    """Flights that flew and have a departure delay."""
    return (F.col("cancelled") == 0) & F.col("depdelay").isNotNull()


def not_cancelled() -> Column:
    return F.col("cancelled") != 1.0


def cancelled_with_code() -> Column:
    return (F.col("cancelled") == 1.0) & (F.col("cancellationcode") != "")


@dataclass(frozen=True)
class FilterSpec:
    months: Optional[Sequence[int]] = None
    carriers: Optional[Sequence[str]] = None
    origins: Optional[Sequence[str]] = None
    date_range: Optional[Tuple[str, str]] = None
    labels: Optional[Sequence[str]] = None


EVERYTHING = FilterSpec()


def _and(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def filter_flights(df: DataFrame, spec: FilterSpec = EVERYTHING, base: Column = None) -> DataFrame:
    """Raw flights; the date range is closed at both ends.

    Months and date range are also tested on the plain ``year`` and ``month``
    columns, so tables partitioned by them are pruned.
    """
    day = F.col("flightdate").cast("date")
    tests = [] if base is None else [base]
    if spec.date_range:
        tests.append(day.between(*[F.lit(d).cast("date") for d in spec.date_range]))
        if {"year", "month"} <= set(df.columns):
            first, last = (int(str(d)[:4]) * 100 + int(str(d)[5:7]) for d in spec.date_range)
            tests.append((F.col("year") * 100 + F.col("month")).between(first, last))
    if spec.months:
        tests.append(F.month(day).isin(list(spec.months)))
        if "month" in df.columns:
            tests.append(F.col("month").isin(list(spec.months)))
    if spec.carriers:
        tests.append(F.col("reporting_airline").isin(list(spec.carriers)))
    if spec.origins:
        tests.append(F.col("origin").isin(list(spec.origins)))
    return df.where(_and(tests))


def filter_scores(df: DataFrame, spec: FilterSpec = EVERYTHING) -> DataFrame:
    """Scored flights; the last day of the range is included whole."""
    tests = []
    if spec.date_range:
        start, end = (F.lit(d).cast("date") for d in spec.date_range)
        tests += [F.col("flight_date") >= start, F.col("flight_date") < F.date_add(end, 1)]
    choices = {"flight_month": spec.months, "airline_code": spec.carriers,
               "Origin": spec.origins, "risk_label": spec.labels}
    tests += [F.col(name).isin(list(v)) for name, v in choices.items() if v and name in df.columns]
    return df.where(_and(tests))


def split_operated(df: DataFrame):
    """(operated, cancelled); a NULL status counts as operated."""
    gone = F.coalesce(F.col("cancelled") == 1.0, F.lit(False))
    return df.where(~gone), df.where(gone)


def within_box(df: DataFrame) -> DataFrame:
    return df.where(C.in_box("lat", "lon"))
