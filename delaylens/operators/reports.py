"""Delay, cancellation and data-quality reports: partial aggregation, small results.

Raw flights use lower-case column names; scored flights the names of
``schemas.SCORE_COLUMNS``. Thresholds and report sizes are parameters.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from delaylens import schemas as S
from delaylens.functions import columns as C
from delaylens.operators import filters, reshape
from delaylens.operators.filters import EVERYTHING, FilterSpec
from delaylens.operators.quantiles import quantiles

def _n():
    return F.count(F.lit(1))


def _flown(df, spec):
    return filters.filter_flights(df, spec, filters.operated())


def _everything(df, spec):
    return filters.filter_flights(df, spec)


def _year_month():
    day = F.col("flightdate").cast("date")
    return F.year(day).alias("year"), F.month(day).alias("month")


def _cancelled():
    return F.count_if(F.col("cancelled") == 1.0)


# --- delays ------------------------------------------------------------------

def kpis(df: DataFrame, spec: FilterSpec = EVERYTHING, threshold=S.DELAY_THRESHOLD) -> DataFrame:
    flew = F.col("cancelled") != 1.0
    late = F.count_if((F.col("depdelay") > threshold) & flew)
    return _everything(df, spec).agg(
        _n().alias("total_flights"), _cancelled().alias("cancelled"), late.alias("delayed"),
        F.try_divide(late, F.count_if(flew)).alias("delay_rate"))


def delay_by_hour(df: DataFrame, spec: FilterSpec = EVERYTHING,
                  threshold=S.DELAY_THRESHOLD) -> DataFrame:
    return (
        _flown(df, spec).where(F.col("crsdeptime").isNotNull())
        .groupBy(C.hhmm_floor("crsdeptime").alias("hour"))
        .agg(C.delay_rate("depdelay", threshold).alias("delay_rate"), _n().alias("n"))
        .where(F.col("hour").between(0, 23)).orderBy("hour"))


def _ranked_delay(df, key, name, threshold, min_n, k):
    grouped = (df.groupBy(F.col(key).alias(name))
               .agg(C.delay_rate("depdelay", threshold).alias("delay_rate"), _n().alias("n"))
               .where(F.col("n") >= min_n))
    return reshape.top_k(grouped, "delay_rate", k, name)


def delay_by_airline(df, spec: FilterSpec = EVERYTHING, threshold=S.DELAY_THRESHOLD,
                     min_n=500, k=20) -> DataFrame:
    """Compares all carriers, so a carrier choice in the filter is not applied."""
    spec = FilterSpec(spec.months, None, spec.origins, spec.date_range)
    return _ranked_delay(_flown(df, spec), "reporting_airline", "airline_code", threshold, min_n, k)


def delay_by_airport(df, spec: FilterSpec = EVERYTHING, threshold=S.DELAY_THRESHOLD,
                     min_n=300, k=30) -> DataFrame:
    spec = FilterSpec(spec.months, spec.carriers, None, spec.date_range)
    return _ranked_delay(_flown(df, spec), "origin", "airport", threshold, min_n, k)


def monthly_trend(df, spec: FilterSpec = EVERYTHING, threshold=S.DELAY_THRESHOLD) -> DataFrame:
    return (
        _flown(df, spec).groupBy(*_year_month())
        .agg(C.delay_rate("depdelay", threshold).alias("delay_rate"), _n().alias("n"))
        .withColumn("label", C.month_label("year", "month")).orderBy("year", "month"))


def delay_causes(df, spec: FilterSpec = EVERYTHING) -> DataFrame:
    totals = filters.filter_flights(df, spec, filters.not_cancelled()).agg(
        *[F.sum(c).alias(label) for c, label in S.CAUSE_COLUMNS.items()])
    return (reshape.melt(totals, [], list(S.CAUSE_COLUMNS.values()), "cause", "total_minutes")
            .dropna(subset=["total_minutes"]))


def delay_sample(df, spec: FilterSpec = EVERYTHING, key="flight_number_reporting_airline",
                 n=80_000) -> DataFrame:
    """At most n delays within the display range, chosen by the hash of the key."""
    shown = _flown(df, spec).where(F.col("depdelay").between(-60, 180))
    return reshape.sample_n(shown.select(key, "depdelay"), key, n)


def histogram(df, column, lo, hi, bins) -> DataFrame:
    """Count per equal-width bin; values outside the range are left out."""
    return (df.select(C.histogram_bin(column, lo, hi, bins).alias("bin"))
            .where(F.col("bin").isNotNull()).groupBy("bin").agg(_n().alias("n")).orderBy("bin"))


def airline_list(df) -> DataFrame:
    return (df.select(F.col("reporting_airline").alias("airline")).dropna()
            .distinct().orderBy("airline"))


def delay_by_dow_hour(df, spec: FilterSpec = EVERYTHING, threshold=S.DELAY_THRESHOLD,
                      min_n=30) -> DataFrame:
    return (
        _flown(df, spec).where(F.col("crsdeptime").isNotNull())
        .groupBy(C.weekday_number(F.col("flightdate").cast("date")).alias("dow"),
                 C.hhmm_floor("crsdeptime").alias("hour"))
        .agg(C.delay_rate("depdelay", threshold).alias("delay_rate"), _n().alias("n"))
        .where(F.col("hour").between(0, 23) & (F.col("n") >= min_n))
        .withColumn("dow_label", C.weekday_label("dow")).orderBy("dow", "hour"))


def dow_hour_matrix(dow_hour: DataFrame, hours=range(24)) -> DataFrame:
    """Weekday rows Mon..Sun, one column per hour, all weekdays present."""
    wide = reshape.pivot_mean(dow_hour, "dow_label", "hour", "delay_rate", hours)
    return reshape.with_scaffold(wide, "dow_label", S.WEEKDAYS[1:] + S.WEEKDAYS[:1])


def mean_delay_by_weekday(df) -> DataFrame:
    means = (df.groupBy(C.weekday_name(F.col("flightdate").cast("date")).alias("weekday"))
             .agg(F.avg("depdelay").alias("mean_delay")))
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    return reshape.with_scaffold(means, "weekday", names)


def mean_delay_by_hour(df) -> DataFrame:
    return (df.groupBy(C.hhmm_hour("crsdeptime", clip=True).alias("dep_hour"))
            .agg(F.avg("depdelay").alias("mean_delay")))


# --- cancellations -----------------------------------------------------------

def _ranked_cancellations(df, key, name, min_n, k):
    grouped = (df.groupBy(F.col(key).alias(name))
               .agg(_cancelled().alias("cancelled"), _n().alias("total"),
                    F.try_divide(_cancelled(), _n()).alias("cancel_rate"))
               .where(F.col("total") >= min_n))
    return grouped if k is None else reshape.top_k(grouped, "cancel_rate", k, name)


def cancellations_by_airline(df, spec: FilterSpec = EVERYTHING, min_n=500, k=20) -> DataFrame:
    spec = FilterSpec(spec.months, None, spec.origins, spec.date_range)
    return _ranked_cancellations(_everything(df, spec), "reporting_airline", "airline_code",
                                 min_n, k)


def cancellations_by_airport(df, spec: FilterSpec = EVERYTHING, min_n=300, k=20) -> DataFrame:
    spec = FilterSpec(spec.months, spec.carriers, None, spec.date_range)
    return _ranked_cancellations(_everything(df, spec), "origin", "airport", min_n, k)


def cancellation_codes(df, spec: FilterSpec = EVERYTHING) -> DataFrame:
    return (
        filters.filter_flights(df, spec, filters.cancelled_with_code())
        .groupBy(F.col("cancellationcode").alias("code")).agg(_n().alias("n"))
        .orderBy(F.desc("n"), "code"))


def cancellation_trend(df, spec: FilterSpec = EVERYTHING) -> DataFrame:
    return (
        _everything(df, spec).groupBy(*_year_month())
        .agg(F.try_divide(_cancelled(), _n()).alias("cancel_rate"), _n().alias("n"))
        .withColumn("label", C.month_label("year", "month")).orderBy("year", "month"))


def _with_top_code(totals, codes):
    top = codes.agg(F.max_by("code", F.struct("n", F.col("code")))).scalar()
    return totals.select(
        "cancelled", "total",
        F.coalesce(F.try_divide("cancelled", "total"), F.lit(0.0)).alias("cancel_rate"),
        F.coalesce(top, F.lit("?")).alias("top_code"))


def cancellation_kpi(df, spec: FilterSpec = EVERYTHING) -> DataFrame:
    totals = _everything(df, spec).agg(_cancelled().alias("cancelled"), _n().alias("total"))
    return _with_top_code(totals, cancellation_codes(df, spec))


def cancellation_kpi_listed(df, spec: FilterSpec = EVERYTHING, min_n=500, k=20) -> DataFrame:
    """The same over the carriers of the ranked carrier table only."""
    listed = cancellations_by_airline(df, spec, min_n, k)
    totals = listed.agg(F.sum("cancelled").alias("cancelled"), F.sum("total").alias("total"))
    return _with_top_code(totals, cancellation_codes(df, spec))


def cancellation_summary(df) -> DataFrame:
    return df.agg(
        _n().alias("total"), F.sum("cancelled").alias("cancelled"),
        (F.avg("cancelled") * 100).alias("cancel_pct"),
        F.count_if(~F.coalesce(F.col("cancelled") == 1.0, F.lit(False))).alias("operated"))


# --- data profiles -----------------------------------------------------------

def missing_profile(df, columns=None) -> DataFrame:
    columns = [c for c in (columns or df.columns) if c in df.columns]
    counts = df.agg(_n().alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (counts.unpivot(["_n"], columns, "column_name", "missing_count")
            .select("column_name", "missing_count",
                    (F.try_divide("missing_count", "_n") * 100).alias("missing_pct"))
            .orderBy(F.desc("missing_pct"), "column_name"))


def table_profile(df, date="flightdate", distinct=()) -> DataFrame:
    return df.agg(
        _n().alias("row_count"), F.lit(len(df.columns)).alias("column_count"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        *[F.countDistinct(c).alias(f"distinct_{c}") for c in distinct])


def numeric_summary(df, column) -> DataFrame:
    x = F.col(column)
    moments = df.agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
        F.try_divide(F.count_if(x > 15), F.count(x)).alias("share_over_15"),
        F.try_divide(F.count_if(x > 60), F.count(x)).alias("share_over_60"),
    ).withColumn("feature", F.lit(column))
    at = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    marks = quantiles(df, [column], list(at.values())).agg(F.struct(*[
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for name, p in at.items()])).scalar()
    return moments.withColumns({name: marks[name] for name in at})


def outlier_report(df, columns, cap=S.DELAY_CAP) -> DataFrame:
    beyond = df.agg(_n().alias("_n"),
                    *[F.count_if(F.abs(F.col(c)) > cap).alias(c) for c in columns])
    return (beyond.unpivot(["_n"], list(columns), "column_name", "extreme")
            .select("column_name", "extreme",
                    (F.try_divide("extreme", "_n") * 100).alias("extreme_pct")))


def key_report(df, key) -> DataFrame:
    """Total, distinct and surplus rows of a key, which may span several columns."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(_n().alias("n"))
    return per_key.agg(F.sum("n").alias("total"), _n().alias("distinct_keys")).select(
        "total", "distinct_keys", (F.col("total") - F.col("distinct_keys")).alias("duplicates"),
        ((F.col("total") - F.col("distinct_keys")) / F.col("total") * 100).alias("duplicate_pct"))


def step_counts(**frames) -> DataFrame:
    """(step, row_count, column_count, null_cells) for each named frame."""
    rows = []
    for position, (name, df) in enumerate(frames.items(), start=1):
        blanks = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
        rows.append(df.agg(_n().alias("row_count"), blanks.alias("null_cells")).select(
            F.lit(position).alias("position"), F.lit(name).alias("step"), "row_count",
            F.lit(len(df.columns)).alias("column_count"), "null_cells"))
    return reshape.union_all(*rows)


# --- scored flights ----------------------------------------------------------

def band_counts(scores) -> DataFrame:
    """Left-closed bands with their shares, and the high-risk count among them."""
    bands = scores.agg(
        _n().alias("total"), *[F.count_if(C.risk_band("risk_score") == b).alias(b)
                            for b in ("Low", "Medium", "High")])
    return bands.unpivot(["total"], ["Low", "Medium", "High"], "band", "n").select(
        "band", "n", (F.col("n") / F.greatest("total", F.lit(1))).alias("share"))


def group_mean(df, by, column, min_n=0, k=None, out="mean") -> DataFrame:
    grouped = (df.groupBy(by).agg(F.avg(column).alias(out), F.count(column).alias("n"))
               .where(F.col("n") >= min_n))
    return grouped if k is None else reshape.top_k(grouped, out, k, by)


def riskiest(scores, k=50) -> DataFrame:
    shown = ["flight_date", "airline_code", "Origin", "Dest", "scheduled_dep_hour", "risk_score",
             "risk_label", "rolling_6_flight_origin_delay_avg", "lag_1_tail_arr_delay_mins",
             "wind_speed_knots"]
    ties = ["flight_date", "Origin", "Dest", "scheduled_dep_hour", "airline_code"]
    shown = [c for c in shown if c in scores.columns]
    ties = [c for c in ties if c in scores.columns]
    best = reshape.top_k(scores.select(*shown), "risk_score", k, ties)
    return best.withColumns({
        "flight_date": F.date_format("flight_date", "yyyy-MM-dd"),
        "risk_score": F.round("risk_score", 3)})


def binned_rate(scores, column, edges=None, min_n=200) -> DataFrame:
    """Delay rate, mean risk and count per right-closed interval of a measure."""
    edges = [float(e) for e in (edges or S.BIN_EDGES[column])]
    middles = F.array(*[F.lit((a + b) / 2) for a, b in zip(edges[:-1], edges[1:])])
    risk = "risk_score" if "risk_score" in scores.columns else "is_delayed"
    return (
        scores.withColumn("bin", C.cut_index(column, edges)).where(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.avg("is_delayed").alias("delay_rate"), F.avg(risk).alias("risk"),
                            F.count("is_delayed").alias("n"))
        .withColumn("mid", F.element_at(middles, F.col("bin") + 1))
        .where(F.col("n") >= min_n).orderBy("bin"))


def wind_hour_matrix(scores) -> DataFrame:
    """Mean delay flag by wind band and departure hour, hours 0-23 as columns."""
    bands = F.array(*[F.lit(x) for x in S.WIND_BAND_LABELS])
    index = C.cut_index("wind_speed_knots", [float(e) for e in S.WIND_BAND_EDGES])
    banded = (scores.withColumn("_i", index).where(F.col("_i").isNotNull())
              .withColumn("wind_band", F.element_at(bands, F.col("_i") + 1)))
    return reshape.pivot_mean(banded, "wind_band", "scheduled_dep_hour", "is_delayed", range(24))


def class_balance(df, label="is_delayed") -> DataFrame:
    sizes = df.groupBy(label).agg(_n().alias("n"))
    return sizes.withColumn("share", F.col("n") / df.agg(_n()).scalar())


def report_rates(scores, by, min_n, k) -> DataFrame:
    """Delay rate per group for the printed report, the k highest in rising order."""
    grouped = (scores.groupBy(by).agg(F.avg("is_delayed").alias("delay_rate"), _n().alias("n"))
               .where(F.col("n") >= min_n))
    return reshape.top_k(grouped, "delay_rate", k, by, display_ascending=True)


def monthly_score_trend(scores) -> DataFrame:
    return (scores.groupBy(F.trunc("flight_date", "MM").alias("month"))
            .agg(F.avg("is_delayed").alias("delay_rate")).orderBy("month"))


def state_rates(airports, states) -> DataFrame:
    """Mean of the airport rates and the sorted airport list per state.

    Both inputs have one row per airport.
    """
    return (airports.join(states, "airport").where(F.col("state").isNotNull())
            .groupBy("state").agg(
                F.avg("delay_rate").alias("delay_rate"),
                F.array_join(F.sort_array(F.collect_list("airport")), ", ").alias("airports")))


def corr_matrix(df, columns) -> DataFrame:
    pairs = [(a, b) for a in columns for b in columns]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                      F.col(f"`{a}|{b}`").alias("corr")) for a, b in pairs]
    return wide.select(F.inline(F.array(*cells)))
